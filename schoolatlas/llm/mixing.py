"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / quality``, with ``u`` drawn from its id and
text by a hash, so reruns agree.  A source takes complete epochs while its target allows; the
rest of the target is filled by the documents with the smallest keys, prefix-summed to the
budget.  The document at the border is cut where the budget ends, so a source misses its
target by less than a word.

No window runs over a whole source.  The keys are cut into ``CELLS`` cells per doubling, so a cell
holds about one document in 2,000 whatever the weights; cell sums are pre-aggregated in the map tasks, the prefix sum
runs over the cells of a source, and only the one cell that the budget ends in is sorted.
The targets come from one row per source: sources are ordered by the ratio at which their cap
is met, and a running sum gives the level that the uncapped ones share.

Only DataFrame functions are used.

Defined cases: sources are ordered by code point with null as the last source; a null or empty
text has size 0 and takes 0; a source of size 0 has target 0; equal keys are ordered by id and
text hash, and rows equal in all of these are interchangeable; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schoolatlas.llm.common import n_words, store

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
CELLS = 1024
SYMBOLS = r"[#*$%&|<>]"


def quality(text: Column) -> Column:
    """Sampling weight of a document: 1 without symbols, falling with their share of the text."""
    share = F.regexp_count(text, F.lit(SYMBOLS)) / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(1 / (1 + 20 * share), F.lit(1.0))


def draw(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) from the first 48 bits of an md5 over id and text."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("/"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one (source, source_size) row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = reduce(lambda rest, i: F.when(place == i, F.lit(weights[i])).otherwise(rest), range(len(weights)), F.lit(None))
    cap = F.col("source_size") * max_epochs
    ratio = Window.orderBy("at", F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("weight", weight.cast("double"))
        .withColumn("at", cap / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("capped", F.coalesce(F.sum(cap).over(before), F.lit(0)).cast("double"))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    )
    # The level if all before a source are capped and it and the rest are not; it rises up to the true one.
    level = F.max((F.col("total") - F.col("capped")) / F.col("open")).over(everything)
    share = F.least(cap.cast("double"), F.col("level") * F.col("weight"))
    return ranked.withColumn("level", level).select("source", "source_size", share.alias("target"))


def _cell(key: Column) -> Column:
    """The cell of a key; cells follow the keys' order."""
    return F.floor(F.log2(key) * CELLS).cast("int")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    weight: Column | None = None,
) -> DataFrame:
    """Per document: doc_id, source, ``draw_key``, ``size``, ``source_size``, ``target``,
    whole ``epochs`` and ``taken`` words."""
    text = F.col("text")
    u = draw(F.col("doc_id"), text)
    rows = store(
        docs.select(
            "doc_id",
            "source",
            n_words(text).alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(-1)).alias("text_crc"),
            (-F.log(u) / (quality(text) if weight is None else weight)).alias("draw_key"),
        )
    ).withColumn("cell", _cell(F.col("draw_key")))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    of_source = Window.partitionBy("source")
    before_cell = of_source.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = store(cells)
    plan = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0)
    plan = plan.withColumn("epochs", whole.cast("long")).withColumn(
        "budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    )
    budgets = cells.withColumn("before", F.coalesce(F.sum("cell_size").over(before_cell), F.lit(0))).withColumnRenamed(
        "source", "cell_source"
    )
    budgets = (
        budgets.join(plan, F.col("cell_source").eqNullSafe(F.col("source")))
        .select("source", "cell", "source_size", "target", "epochs", (F.col("budget") - F.col("before")).alias("left"), "cell_size")
        .withColumnRenamed("source", "of")
        .withColumnRenamed("cell", "at")
    )
    joined = rows.join(budgets, F.col("source").eqNullSafe(F.col("of")) & (F.col("cell") == F.col("at")))
    settled = (F.col("left") <= 0) | (F.col("left") >= F.col("cell_size"))
    out = ["doc_id", "source", "draw_key", "size", "source_size", "target", "epochs"]
    even = joined.filter(settled).select(
        *out, (F.col("epochs") * F.col("size") + F.when(F.col("left") > 0, F.col("size")).otherwise(0)).alias("taken")
    )
    order = of_source.orderBy("draw_key", "doc_id", "text_crc").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("left") - F.coalesce(F.sum("size").over(order), F.lit(0))
    border = joined.filter(~settled).select(
        *out, (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), room))).alias("taken")
    )
    return even.unionByName(border)


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, each as often as the mix takes it: whole epochs, and once more up to the border
    document of its source, which counts if at least half of it is taken.  Columns stay as they are.

    The texts are not moved: one row per source says how many epochs and up to which key.  Rows
    equal in id and text at the border are taken together.
    """
    part = F.col("taken") - F.col("epochs") * F.col("size")
    limits = (
        mix(docs, **options)
        .filter("size > 0")
        .groupBy(F.col("source").alias("_source"))
        .agg(F.max("epochs").alias("_epochs"), F.max(F.when(2 * part >= F.col("size"), F.col("draw_key"))).alias("_last"))
    )
    limits = store(limits)
    text, weight = docs["text"], options.get("weight")
    key = -F.log(draw(docs["doc_id"], text)) / (quality(text) if weight is None else weight)
    rows = docs.select(F.struct(*docs.columns).alias("row"), docs["source"].alias("source"), key.alias("key"), n_words(text).alias("size"))
    joined = rows.join(limits, rows["source"].eqNullSafe(limits["_source"]))
    copies = F.col("_epochs") + F.when(F.col("key") <= F.col("_last"), 1).otherwise(0)
    times = F.when(F.col("size") > 0, copies).otherwise(0).cast("int")
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).select("row.*")

"""Secret scan with multipart credential linking.

Strong parts are reported wherever they stand: assignments to a secret's name (``assign``),
access identifiers (``access``) and long hex runs (``hex``).  Weak parts could be anything by
themselves: account names (``identifier``), short assigned values and long mixed tokens
(``secret``), addresses (``endpoint``).  An interval join within a document links a weak part with
a part that completes it and lies at most ``REACH`` code points away without overlapping: an
identifier or an endpoint needs a secret, a secret needs an identifier or an endpoint.  Only
linked weak parts are reported; a weak secret that overlaps a strong part is that part.

The join is an equi-join on (text, cell): a part lies in the cells of ``REACH`` code points that
it touches, a weak part asks the cells within reach, and a semi join stops at the first partner.
Documents stay where they are; parts are found once per distinct text, so a large group of copies
costs one text.  Only DataFrame functions are used.

Positions are code points, ends exclusive.  Within a kind matches are leftmost and do not
overlap; a match that fails its length is dropped after it has taken its place.

Defined cases: a null or empty text has no spans; spans are ordered by start, kind, end; rows
of equal text get equal results; other columns do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schoolatlas.llm.common import store, text_key

REACH = 200
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
IDENTIFIER = r"""(?i)(user|username|login|account|client_?id|access_?key(_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}"""
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""[a-z][a-z0-9+.-]*://[^\x00-\x20"'<>]+|[0-9]{1,3}(\.[0-9]{1,3}){3}(:[0-9]{1,5})?"""
#: In the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
STRONG = KINDS[:3]
PLACE = {kind: i for i, kind in enumerate(KINDS)}


def _found(pattern: str, value: Column | None = None, group: int = 0) -> Column:
    """The matches of a pattern: how many code points lie before each since the last one, its length, and its value."""
    text = F.col("text")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(matches)).alias("gap"), matches.alias("match"), values.alias("value")
    )
    found = F.transform(
        zipped,
        lambda z: F.struct(
            F.length(z["gap"]).alias("gap"), F.length(z["match"]).alias("length"), z["value"].alias("value")
        ),
    )
    none = F.array().cast("array<struct<gap: int, length: int, value: string>>")
    return F.when(F.size(matches) > 0, found).otherwise(none)


def _parts(docs: DataFrame) -> DataFrame:
    """(text_1, text_2, kind, i, start, stop, value) of all matches of all patterns in the distinct texts."""
    patterns = {
        "assign": _found(ASSIGN, group=2),
        "access": _found(ACCESS),
        "hex": _found(HEX),
        "identifier": _found(IDENTIFIER),
        "secret": _found(TOKEN),
        "endpoint": _found(ENDPOINT),
    }
    return docs.select("doc_id", *text_key(F.col("text")), *(f.alias(kind) for kind, f in patterns.items()))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per document: doc_id, ``base`` and ``spans`` as arrays of (start, kind, stop), kind as its place in KINDS."""
    found = store(_parts(docs.select("doc_id", "text")))
    key = ["text_1", "text_2"]
    any_part = reduce(lambda a, b: a | b, (F.size(kind) > 0 for kind in KINDS))

    def tag(kind: str) -> Column:
        place = F.lit(PLACE[kind]).alias("kind")
        return F.transform(kind, lambda m, i: F.struct(place, i.alias("i"), m["gap"], m["length"], m["value"]))

    tagged = F.concat(*map(tag, KINDS))
    matches = found.filter(any_part).select(*key, F.explode(tagged).alias("m")).select(*key, "m.*")
    matches = matches.groupBy(*key, "kind", "i").agg(*(F.first(c).alias(c) for c in ("gap", "length", "value")))
    so_far = Window.partitionBy(*key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.col("length")).over(so_far).cast("int")
    size = F.length("value")
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    kind = (
        F.when((F.col("kind") == PLACE["assign"]) & (size < ASSIGN_LEAST), F.when(size >= 4, F.lit(PLACE["secret"])))
        .when((F.col("kind") == PLACE["secret"]) & ~mixed, F.lit(None))
        .otherwise(F.col("kind"))
    )
    parts = matches.withColumn("stop", stop).select(
        *key, (F.col("stop") - F.col("length")).alias("start"), kind.alias("kind"), "stop"
    )
    parts = store(parts.filter("kind is not null").distinct())
    strong = parts.filter(F.col("kind") < len(STRONG))
    weak = parts.filter(F.col("kind") >= len(STRONG))
    role = (
        F.when(F.col("kind").isin(PLACE["access"], PLACE["identifier"]), "identifier")
        .when(F.col("kind") == PLACE["endpoint"], "endpoint")
        .otherwise("secret")
    )
    cell = lambda place: F.floor(place / reach).cast("int")
    there = parts.select(
        *(F.col(c).alias(f"_{c}") for c in (*key, "start", "stop")),
        (F.col("kind") < len(STRONG)).alias("_strong"),
        role.alias("_role"),
        F.explode(F.sequence(cell(F.col("start")), cell(F.col("stop") - 1))).alias("_cell"),
    )
    asks = weak.withColumn("role", role).withColumn(
        "cell", F.explode(F.sequence(cell(F.greatest(F.col("start") - reach, F.lit(0))), cell(F.col("stop") + reach)))
    )
    same = (F.col("text_1") == F.col("_text_1")) & (F.col("text_2") == F.col("_text_2")) & (F.col("cell") == F.col("_cell"))
    apart = (F.col("_stop") <= F.col("start")) | (F.col("_start") >= F.col("stop"))
    near = (F.col("_stop") >= F.col("start") - reach) & (F.col("_start") <= F.col("stop") + reach)
    completes = F.when(F.col("role") == "secret", F.col("_role") != "secret").otherwise(F.col("_role") == "secret")
    linked = asks.join(there, same & apart & near & completes, "left_semi")
    # A part asks several cells: (text, start, kind, stop) once each.
    linked = linked.select(*key, "start", "kind", "stop").distinct()
    # A secret counts as covered if any of its cells shows a strong part over it.
    hidden = asks.join(there.filter("_strong"), same & ~apart & (F.col("role") == "secret"), "left_semi")
    linked = linked.join(hidden.select(*key, "start", "kind", "stop").distinct(), [*key, "start", "kind", "stop"], "left_anti")
    span = F.struct("start", "kind", "stop")
    spans = strong.unionByName(linked).groupBy(*key).agg(F.array_sort(F.collect_list(span)).alias("spans"))
    docs_with = found.filter(any_part).select("doc_id", *key).join(spans, key, "left").select("doc_id", "spans")
    docs_without = found.filter(~any_part).select("doc_id", F.lit(None).cast(docs_with.schema["spans"].dataType).alias("spans"))
    spans = F.coalesce("spans", F.array().cast(docs_with.schema["spans"].dataType))
    return docs_with.unionByName(docs_without).select(
        "doc_id", F.filter(spans, lambda s: s["kind"] < len(STRONG)).alias("base"), spans.alias("spans")
    )


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))),
    )


def report(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    counts = [
        F.size(F.filter(F.col("base")["kind"], lambda k: k == F.lit(place))).cast("long").alias(f"n_{kind}")
        for place, kind in enumerate(STRONG)
    ]
    return scan(docs, reach).select(
        "doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )

"""Language identification by prediction by partial matching (PPM).

For every language a tree of byte contexts of length 0 to ``ORDER`` counts which byte
followed.  A byte costs ``-log2(count / (total + kinds))`` bits in the longest context
that has seen it, plus ``-log2(kinds / (total + kinds))`` bits of escape for every longer
context that has seen other bytes only; a context never seen costs nothing, and a byte
never seen at all costs 8 bits.  The counts are frozen after learning, so the bits of a
text are an exact sum, and the language with the fewest bits wins.

The trees of all languages are stored as one: each node holds a bit count per language,
so a text is walked once however many languages there are.  The bytes that the tree lacks
are settled by shorter contexts, again for all languages at once.

Learning reads a bounded sample: of every language the documents with the smallest hashed
ids, up to ``DOCS_PER_LANGUAGE`` documents and ``BYTES_PER_LANGUAGE`` bytes.  A text of more
than ``PART_CHARS`` characters teaches by a part of so many, from a hashed place on, so that
no long text takes or blocks the budget of its language.  Contexts are counted in Spark; the
model's size follows the sample's, never the corpus.

Defined cases: a null or empty text, or one without a letter, is ``und`` with score 0; on
equal bits the language first by code point wins; without any learning row everything is
``und``; a very long text is scored in pieces, with the result of the whole; rows of null lang or null id teach nothing; repeated rows are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schoolatlas.llm.common import ship, slices, text_bytes

ORDER = 3
DOCS_PER_LANGUAGE = 600
BYTES_PER_LANGUAGE = 1_000_000
PART_CHARS = 50_000
#: Texts are scored in pieces of so many bytes, whatever their length.
PIECE_BYTES = 1 << 17
FOLDS = 5

ship(__name__)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learning_sample(
    docs: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    bytes_per_language: int = BYTES_PER_LANGUAGE,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """(lang, text) of the rows to learn from: the bounded sample of the rows that are not held out."""
    rows = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    # A hash below share * 2^63 keeps about four times the rows needed; languages below that keep all.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("of_lang"))
    hashed = rows.select("lang", "text", (F.xxhash64("doc_id", F.lit("sample")).bitwiseAND(F.lit((1 << 62) - 1))).alias("draw"))
    spare = F.length("text") - part_chars
    part = F.substring(F.col("text"), (F.col("draw") % (spare + 1) + 1).cast("int"), F.lit(part_chars))
    few = hashed.join(F.broadcast(sizes), "lang").filter(
        F.col("draw") < F.lit(float(1 << 62)) * F.least(F.lit(1.0), F.lit(4.0 * docs_per_language) / F.col("of_lang"))
    )
    order = Window.partitionBy("lang").orderBy("draw", "text")
    return (
        few.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= docs_per_language)
        .withColumn("text", F.when(spare > 0, part).otherwise(F.col("text")))
        .withColumn("until", F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("place")))
        .filter(F.col("until") <= bytes_per_language)
        .select("lang", "text")
    )


def _padded(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (byte + 1) of all texts, each after ``order`` zeros; first and end position of every text."""
    lengths = np.diff(offsets)
    first = offsets[:-1] + order * np.arange(1, len(offsets))
    out = np.zeros(len(data) + order * len(lengths), np.int64)
    out[np.arange(len(data)) + np.repeat(order * np.arange(1, len(offsets)), lengths)] = data
    filled = np.zeros(len(out), bool)
    filled[np.arange(len(data)) + np.repeat(order * np.arange(1, len(offsets)), lengths)] = True
    out[filled] += 1
    return out, first, first + lengths


def _grams(symbols: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` symbols that end at the positions, as one number of base 257."""
    out = np.zeros(len(at), np.int64)
    for back in range(length - 1, -1, -1):
        out = out * 257 + symbols[at - back]
    return out


def gram_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, length, gram, n): how often each string of 1 to order + 1 symbols occurs in a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                data, offsets = text_bytes(batch.column("text").filter(pa.array(langs == lang)))
                symbols, first, end = _padded(data, offsets, order)
                at = np.flatnonzero(symbols)
                for length in range(1, order + 2):
                    gram, n = np.unique(_grams(symbols, at, length), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), length, np.int32)), pa.array(gram), pa.array(n)],
                        names=["lang", "length", "gram", "n"],
                    )

    counted = sample.mapInArrow(count, "lang string, length int, gram bigint, n bigint")
    return counted.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Frozen statistics of all languages: the union tree of contexts, with bits per language at its nodes."""

    def __init__(self, rows: list, order: int = ORDER):
        self.order = order
        self.langs = sorted({r.lang for r in rows})
        place = {lang: i for i, lang in enumerate(self.langs)}
        width = len(self.langs)
        counts = []
        for length in range(1, order + 2):
            own = [r for r in rows if r.length == length]
            grams = np.unique(np.array([r.gram for r in own], np.int64))
            n = np.zeros((len(grams), width))
            at = np.searchsorted(grams, np.array([r.gram for r in own], np.int64))
            np.add.at(n, (at, np.array([place[r.lang] for r in own], np.int64)), [r.n for r in own])
            counts.append((grams, n))
        #: Symbols get small numbers; 0 stands for all that was never seen, 1 for the start of a text.
        seen = counts[0][0]
        self.symbol = np.zeros(257, np.int64)
        self.symbol[0] = 1
        self.symbol[seen] = np.arange(len(seen)) + 2
        self.n_symbols = len(seen) + 2
        self.child, self.bits, self.escape = [], [], []
        shorter = np.full((257, width), 8.0)  # bits of a symbol without context, were it never seen
        node_of = {0: 0}  # context gram -> node, at the length before; the empty context is node 0
        for length, (grams, n) in enumerate(counts, 1):
            context, last = grams // 257, grams % 257
            contexts, owner = np.unique(context, return_inverse=True)
            total, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
            np.add.at(total, owner, n)
            np.add.at(kinds, owner, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                away = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                hit = -np.log2(n / (total + kinds)[owner])
            if length == 1:
                back = shorter[last]
            else:
                suffix = grams % 257 ** (length - 1)
                back = self.bits[-1][np.searchsorted(counts[length - 2][0], suffix) + 1]
            bits = np.where(n > 0, hit, away[owner] + back)
            self.bits.append(np.vstack([np.zeros((1, width)), bits]))
            # Nodes of contexts: 0 is "not in the tree", contexts of the sample's starts included.
            node = {c: i + (length > 1) for i, c in enumerate(contexts.tolist())}
            escape = np.zeros((len(contexts) + 1, width))
            escape[np.array(list(node.values()), np.int64)] = away
            self.escape.append(escape)
            child = np.zeros((len(contexts) + 1, self.n_symbols), np.int32)
            child[[node[c] for c in context.tolist()], self.symbol[last]] = np.arange(len(grams)) + 1
            self.child.append(child)
            node_of = node
            self.node = getattr(self, "node", [])
            self.node.append(node_of)
        self._link()

    def _link(self) -> None:
        """Per length: the context's node by the node of the context one symbol shorter at its front."""
        self.step = []
        for length in range(1, self.order + 1):
            nodes = self.node[length]  # contexts of this many symbols
            before = self.node[length - 1]
            step = np.zeros((len(before) + 1, self.n_symbols), np.int32)
            for gram, number in nodes.items():
                front = before.get(gram // 257)
                if front is not None:
                    step[front, self.symbol[gram % 257]] = number
            self.step.append(step)

    def total_bits(self, data: np.ndarray, offsets: np.ndarray, piece: int = PIECE_BYTES) -> np.ndarray:
        """Bits of every text under every language.

        Texts are scored in pieces; a later piece starts with the bytes before it as context, so
        the sum is that of the whole text.
        """
        sums = np.zeros((len(offsets) - 1, len(self.langs)))
        starts, owners = [], []
        for text in range(len(offsets) - 1):
            own = list(range(int(offsets[text]), int(offsets[text + 1]), piece)) or [int(offsets[text])]
            starts += own
            owners += [text] * len(own)
        starts, owners = np.array(starts, np.int64), np.array(owners, np.int64)
        ends = np.minimum(starts + piece, offsets[owners + 1])
        known = np.minimum(self.order, starts - offsets[owners])
        for a, b in slices(ends - starts, piece):
            parts = [data[s - k : e] for s, k, e in zip(starts[a:b].tolist(), known[a:b].tolist(), ends[a:b].tolist())]
            cuts = np.r_[0, np.cumsum([len(part) for part in parts])].astype(np.int64)
            np.add.at(sums, owners[a:b], self._bits(np.concatenate(parts), cuts, known[a:b]))
        return sums

    def _bits(self, data: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Bits of every piece behind its first ``known`` bytes."""
        symbols, first, end = _padded(data, offsets, self.order)
        first = first + known
        small = self.symbol[symbols]
        n = len(small)
        # contexts[k][i]: node of the k symbols before position i.
        contexts = [np.zeros(n, np.int32)]
        for step in self.step:
            longer = np.zeros(n, np.int32)
            longer[1:] = step.ravel()[contexts[-1][:-1] * self.n_symbols + small[:-1]]
            contexts.append(longer)
        entry = self.child[-1].ravel()[contexts[-1] * self.n_symbols + small]
        out = self.bits[-1][entry]
        left = np.flatnonzero(entry == 0)
        context = contexts[-1][left]
        for length in range(self.order, -1, -1):
            out[left] += self.escape[length][context]
            if length:
                context = contexts[length - 1][left]
                entry = self.child[length - 1].ravel()[context * self.n_symbols + small[left]]
                found = entry > 0
                out[left[found]] += self.bits[length - 1][entry[found]]
                left, context = left[~found], context[~found]
        out[left] += 8.0
        out[symbols == 0] = 0
        for back in range(int(known.max(initial=0))):  # bytes that are context only
            out[first[known > back] - 1 - back] = 0
        sums = np.zeros((len(first), out.shape[1]))
        some = np.flatnonzero(end > first)
        if len(some):
            sums[some] = np.add.reduceat(out, first[some], axis=0)
        return sums


def learn(docs: DataFrame, order: int = ORDER, **bounds: int) -> Model:
    """The model of the bounded sample of the documents that are not held out."""
    return Model(gram_counts(learning_sample(docs, **bounds), order).collect(), order)


def identify(docs: DataFrame, model: Model, text: Column | None = None) -> DataFrame:
    """The rows with ``lang_pred``, ``score`` (posterior under equal priors) and ``bits_per_byte`` appended.

    ``text`` is the column ``text`` if not given.  Columns of these names that the input has are replaced.
    """
    made = ("lang_pred", "score", "bits_per_byte")
    docs = docs.drop(*made)
    if not model.langs:
        return docs.select("*", F.lit("und").alias(made[0]), F.lit(0.0).alias(made[1]), F.lit(None).cast("double").alias(made[2]))
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)

    def predict(columns: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        names = np.array(model.langs, object)
        for batch in columns:
            data, offsets = text_bytes(batch.column("_text"))
            bits = model.total_bits(data, offsets)
            best = bits.argmin(axis=1)
            least = bits.min(axis=1)
            score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            per_byte = least / np.maximum(np.diff(offsets), 1)
            und = ~np.array(batch.column("_letters").to_pylist(), bool)
            score[und] = 0.0
            lang = names[best]
            lang[und] = "und"
            kept = [batch.column(i) for i in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(lang, pa.string()), pa.array(score), pa.array(per_byte, mask=und)],
                names=[*batch.schema.names[:-2], *made],
            )

    schema = docs.schema
    for name, kind in zip(made, ("string", "double", "double"), strict=True):
        schema = schema.add(name, kind)
    text = docs["text"] if text is None else text
    return docs.select("*", text.alias("_text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letters")).mapInArrow(predict, schema)

"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document of smaller id.

1. Anchors.  Of the ``LENGTH - SEED + 1`` seeds in a window of ``LENGTH`` bytes the first with the least hash is
   the window's anchor.  Equal windows have equal anchors, so all that a window can match is found at
   its anchor's seed.  A document's windows with one anchor are a run; the run's bytes are its context.
2. Runs meet by seed, in buckets, as a few bytes each.  Of equal contexts the one of least id covers the
   others, first within the map tasks, then in the bucket.  A seed left with one context is settled.
3. Different contexts of one seed can still share windows.  Only these contexts are cut out of their texts;
   the contexts of a seed are joined to one string, and its suffix array (``suffix_array``) puts equal
   windows side by side.  Within such a range the least id covers the others.  A context that a text
   holds more than once is cut out once, with all its places.
4. The covered bytes go back to the texts, which meet them in buckets of ids, packed and compressed.

Hot keys are split.  Seeds in a ``HEAVY_PART``-th of all documents or more (found by map-side counts) and
seeds with more than ``MOST_CONTEXTS`` contexts are replaced by their single windows, each a key of its own
that needs no array.  Contexts are compared by hashes of 40 bits within one seed, single windows always by
64 bits, in buckets of their own; within the suffix arrays bytes are compared.

Defined cases: a null or empty text has no bytes; a null id is larger than all others and null ids are
equal; rows of one id never cover each other, rows equal in id and text get equal results; other columns do
not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolatlas.llm.common import every_span, mix, prefix_sums, ship, slices, span_hashes, store, text_bytes
from schoolatlas.llm.suffix_array import suffix_arrays

LENGTH, SEED = 50, 24
HEAVY_PART = 500
HEAVY_LEAST = 64
SEEN_LEAST = 16
MOST_CONTEXTS = 64
BUCKET_ANCHORS = 1_500_000
BUCKET_BYTES = 8 << 20
#: Anchors a byte, a little above what random hashes give.
DENSITY = 0.08
SLICE = 1 << 20
BATCH_CELLS = 1 << 21
#: Places that fit below a hash's upper bits.
PIECE = 1 << 20
NO_ID = np.iinfo(np.int64).max
_TAG = np.uint64(0xA24BAED4963EE407)
_LOW40 = np.uint64((1 << 40) - 1)

ship(__name__)


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """Place of the first least value among each ``window`` consecutive ones.

    Values are compared by their upper bits, so that a place fits below them; pieces overlap by a window.
    """
    out = np.empty(len(values) - window + 1, np.int64)
    step = PIECE - window
    for at in range(0, len(out), step):
        piece = values[at : at + step + window - 1]
        best = (piece & ~np.uint64(PIECE - 1)) | np.arange(len(piece), dtype=np.uint64)
        span = 1
        while 2 * span <= window:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        n, shift = len(piece) - window + 1, window - span
        best = np.minimum(best[:n], best[shift : shift + n])
        out[at : at + n] = (best & np.uint64(PIECE - 1)).astype(np.int64)
        out[at : at + n] += at
    return out


def runs(data: np.ndarray, offsets: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per run of windows with one anchor: row, first and last window, seed hash, context hash, and if it is single.

    Windows of heavy seeds are single: runs of one, with the window's hash as seed and context.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    sums = prefix_sums(data)
    seeds = every_span(sums, SEED)
    anchor = _least(seeds, LENGTH - SEED + 1)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    window = np.flatnonzero(row[: len(anchor)] == row[LENGTH - 1 :][: len(anchor)])
    anchor = anchor[window]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    lo, hi, at = window[first], window[np.append(first[1:], len(window)) - 1], anchor[first]
    seed = seeds[at]
    context = span_hashes(sums, lo, hi + LENGTH) ^ mix((at - lo).astype(np.uint64) + _TAG)
    single = np.zeros(len(seed), bool)
    if len(heavy) and len(seed):
        is_heavy = heavy[np.minimum(np.searchsorted(heavy, seed), len(heavy) - 1)] == seed
        if is_heavy.any():
            own = _windows(lo[is_heavy], hi[is_heavy])
            name = span_hashes(sums, own, own + LENGTH) ^ _TAG
            keep = ~is_heavy
            lo, hi = np.concatenate([lo[keep], own]), np.concatenate([hi[keep], own])
            seed, context = np.concatenate([seed[keep], name]), np.concatenate([context[keep], name])
            single = np.arange(len(lo)) >= keep.sum()
    return row[lo], lo, hi, seed, context, single


def _names(seed: np.ndarray, context: np.ndarray) -> np.ndarray:
    """The 64 bits by which a document finds a run again, from the 40 bits that are sent of its seed and context."""
    return mix(seed & _LOW40) ^ mix((context & _LOW40) + _TAG)


def _windows(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    width = hi - lo + 1
    return np.repeat(lo - (np.cumsum(width) - width), width) + np.arange(width.sum())


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _text_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(batch.column("text"))
    for a, b in slices(np.diff(offsets), SLICE):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


_NUMBERS = ("bucket", "kind", "bytes", "singles")
_FIVE = np.dtype([("low", "<u4"), ("high", "u1")])


def _five(values: np.ndarray) -> bytes:
    """The lower 40 bits of each value, as five bytes."""
    out = np.empty(len(values), _FIVE)
    out["low"], out["high"] = values & np.uint64(0xFFFFFFFF), (values >> np.uint64(32)) & np.uint64(0xFF)
    return out.tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.frombuffer(data, _FIVE)
    return out["low"].astype(np.uint64) | out["high"].astype(np.uint64) << np.uint64(32)


def _doc_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _split(keys: np.ndarray, then: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(key, places) of each distinct key; places in the order of ``then``."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable") if then is None else np.lexsort((then, keys))
    cuts = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(keys)).tolist(), strict=True):
        yield int(keys[order[a]]), order[a:b]


def _joined(table: pa.Table, name: str) -> bytes:
    return b"".join(table.column(name).to_pylist())


def _numbers(table: pa.Table, name: str, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(_joined(table, name), kind)


def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    kinds = [pa.int64() if n in _NUMBERS else pa.binary() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def heavy_seeds(docs: DataFrame) -> tuple[np.ndarray, int, int]:
    """Seeds in a HEAVY_PART-th of the documents by map-side counts, the bytes of all texts, the heavy seeds' windows.

    A batch in which a heavy seed is too rare to be counted is taken to have SEEN_LEAST documents with it.
    """
    none = np.zeros(0, np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, widths, size = [none], [none.astype(np.int64)], 0
            for _, _, data, offsets in _text_slices(batch):
                row, lo, hi, seed, _, _ = runs(data, offsets, none)
                _, at, own = np.unique(seed ^ row.astype(np.uint64) * _TAG, return_index=True, return_inverse=True)
                seen.append(seed[at])
                widths.append(np.bincount(own, hi - lo + 1, len(at)).astype(np.int64))
                size += len(data)
            seed, own, n = np.unique(np.concatenate(seen), return_inverse=True, return_counts=True)
            windows = np.bincount(own, np.concatenate(widths), len(seed)).astype(np.int64)
            often = n >= SEEN_LEAST
            # The last row has the batch itself.
            seed, n, windows = (np.append(x[often].view(np.int64), 0) for x in (seed, n, windows))
            sizes = np.zeros(len(seed), np.int64)
            sizes[-1] = size
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seed, n, windows, sizes)], names=names)

    names = ["seed", "n", "windows", "bytes"]
    counted = docs.select("text").mapInArrow(count, ", ".join(f"{x} bigint" for x in names))
    sums = [F.sum(x).alias(x) for x in names[1:]]
    counted = store(counted.groupBy("seed").agg(*sums, F.count("*").alias("batches")))
    size, batches = counted.agg(F.sum("bytes"), F.max("batches")).first()
    least = max(HEAVY_LEAST, docs.count() // HEAVY_PART)
    # At most HEAVY_PART times the anchors of the mean document.
    found = counted.filter(F.col("n") >= least).select("seed", "n", "windows", "batches").toArrow()
    seed, n, windows, own = (found.column(x).to_numpy().astype(np.int64) for x in ("seed", "n", "windows", "batches"))
    expanded = windows + windows / np.maximum(n, 1) * SEEN_LEAST * ((batches or 0) - own)
    return np.sort(seed.view(np.uint64)), int(size or 0), int(expanded.sum())


_SENT = ["bucket", "ids", "lengths", "seeds", "contexts"]
_REPLY = ["bucket", "ids", "names", "flags", "singles"]
_COVER = ["kind", "bucket", "ids", "texts", "lo", "hi", "seeds", "lengths", "data"]
COVER, CONTEXT, SINGLE = 0, 1, 2


def _sql(names: list[str]) -> str:
    return ", ".join(f"{n} {'bigint' if n in _NUMBERS else 'binary'}" for n in names)


def _covers(ids: np.ndarray, texts: np.ndarray, lo: np.ndarray, hi: np.ndarray, buckets: int) -> list[tuple]:
    """Rows of covered bytes, by bucket of ids."""
    rows = []
    for bucket, at in _split(_doc_bucket(ids, buckets)):
        numbers = (x[at].astype(k).tobytes() for x, k in ((ids, np.int64), (texts, np.int64), (lo, np.int64), (hi, np.int64)))
        rows.append((COVER, bucket, *numbers, b"", b"", b""))
    return rows


class Plan:
    """Numbers of buckets, and the heavy seeds."""

    def __init__(self, docs: DataFrame):
        heavy, size, windows = heavy_seeds(docs)
        self.heavy = docs.sparkSession.sparkContext.broadcast(heavy)
        self.seed_buckets = max(1, int(size * DENSITY) // BUCKET_ANCHORS)
        self.window_buckets = max(1, windows // BUCKET_ANCHORS)
        self.doc_buckets = max(1, size // BUCKET_BYTES)


def match_runs(docs: DataFrame, plan: Plan) -> DataFrame:
    """(bucket of ids, ids, names, flags, number of single ones): what is known of each run: covered, or to be cut out.

    Single windows meet in buckets after those of the seeds, by their whole hashes, which are their names.
    """
    held, seed_buckets, doc_buckets, window_buckets = plan.heavy, plan.seed_buckets, plan.doc_buckets, plan.window_buckets

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held_back = _ids(batch.column("doc_id")), []
            for a, _, data, offsets in _text_slices(batch):
                row, _, _, seed, context, single = runs(data, offsets, held.value)
                held_back.append((ids[a + row], seed, context, single))
            # Several slices are merged before they are sent, so that copies in them meet here.
            for i in range(0, len(held_back), 8):
                doc, seed, context, single = (np.concatenate(x) for x in zip(*held_back[i : i + 8], strict=True))
                order = np.lexsort((doc, context))
                doc, seed, context, single = doc[order], seed[order], context[order], single[order]
                first = np.r_[True, context[1:] != context[:-1]]
                again = ~first & np.r_[False, doc[1:] == doc[:-1]]
                least = doc[np.flatnonzero(first)][np.cumsum(first) - 1] if len(doc) else doc
                covered = (doc > least) & ~again
                rows = []
                name, told = np.where(single, context, _names(seed, context))[covered], doc[covered]
                doc, seed, context, single = doc[first], seed[first], context[first], single[first]
                to = mix(seed)
                to = np.where(single, seed_buckets + to % np.uint64(window_buckets), to % np.uint64(seed_buckets))
                for bucket, at in _split(to.astype(np.int64), doc):
                    own = doc[at]
                    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    lengths = np.diff(np.append(starts, len(own))).astype(np.int32)
                    keys = (_five(seed[at]), _five(context[at])) if bucket < seed_buckets else (b"", context[at].tobytes())
                    rows.append((bucket, own[starts].tobytes(), lengths.tobytes(), *keys))
                for bucket, at in _split(_doc_bucket(told, doc_buckets)):
                    rows.append((-1 - bucket, told[at].tobytes(), b"", b"", name[at].tobytes()))
                yield _batch(_SENT, rows)

    def replies(doc: np.ndarray, name: np.ndarray, flag: np.ndarray) -> pa.Table:
        rows = [
            (b, doc[at].tobytes(), name[at].tobytes(), flag[at].tobytes(), int((flag[at] == SINGLE).sum()))
            for b, at in _split(_doc_bucket(doc, doc_buckets), doc)
        ]
        return pa.Table.from_batches([_batch(_REPLY, rows)])

    def match(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            n = len(_joined(table, "ids")) // 8
            rows = [(-1 - bucket, _joined(table, "ids"), _joined(table, "contexts"), bytes(n), 0)]
            return pa.Table.from_batches([_batch(_REPLY, rows)])
        doc = np.repeat(_numbers(table, "ids"), _numbers(table, "lengths", np.int32))
        if bucket >= seed_buckets:
            name = _numbers(table, "contexts", np.uint64)
            order = np.lexsort((doc, name))
            doc, name = doc[order], name[order]
            new = np.r_[True, name[1:] != name[:-1]]
            told = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
            doc, name = doc[told], name[told]
            return replies(doc, name, np.full(len(doc), COVER, np.uint8))
        seed, context = _from_five(_joined(table, "seeds")), _from_five(_joined(table, "contexts"))
        order = np.lexsort((doc, context, seed))
        doc, seed, context = doc[order], seed[order], context[order]
        new_seed = np.r_[True, seed[1:] != seed[:-1]]
        new = new_seed | np.r_[True, context[1:] != context[:-1]]
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        starts = np.flatnonzero(new_seed)
        group = np.cumsum(new_seed) - 1
        several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
        contexts = np.add.reduceat(new, starts, dtype=np.int64)
        flag = np.where(contexts > MOST_CONTEXTS, SINGLE, CONTEXT)[group]
        flag[doc > least] = COVER
        told = (doc > least) | (new & (several & (contexts > 1))[group])
        return replies(doc[told], _names(seed[told], context[told]), flag[told].astype(np.uint8))

    sent = docs.select("doc_id", "text").mapInArrow(send, _sql(_SENT))
    return store(sent.groupBy("bucket").applyInArrow(match, _sql(_REPLY)))


_PACKED = ["bucket", "bytes", "ids", "texts", "lengths", "data"]


def packed(docs: DataFrame, plan: Plan) -> DataFrame:
    """The texts by bucket of ids, compressed together."""
    buckets = plan.doc_buckets

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = _ids(batch.column("doc_id")), batch.column("text_1").to_numpy()
            data, offsets = text_bytes(batch.column("text"))
            lengths = np.diff(offsets)
            rows = []
            for bucket, at in _split(_doc_bucket(ids, buckets)):
                for a, b in slices(lengths[at], SLICE):
                    own = at[a:b]
                    body = b"".join(data[offsets[i] : offsets[i + 1]].tobytes() for i in own)
                    rows.append(
                        (bucket, len(body), ids[own].tobytes(), texts[own].tobytes(), lengths[own].astype(np.int64).tobytes(),
                         pa.compress(body, codec="zstd", asbytes=True) if body else b"")
                    )
            yield _batch(_PACKED, rows)

    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_1"), "text")
    return keyed.mapInArrow(pack, _sql(_PACKED))


def _unpack(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, text hashes, bytes and offsets of the packed pieces, some SLICE bytes of them at a time."""
    for a, b in slices(table.column("bytes").to_numpy(), SLICE):
        rows = table.slice(a, b - a).select(_PACKED[1:]).to_pylist()
        ids, texts, lengths = (np.frombuffer(b"".join(r[n] for r in rows), np.int64) for n in ("ids", "texts", "lengths"))
        body = b"".join(pa.decompress(r["data"], r["bytes"], codec="zstd", asbytes=True) for r in rows if r["bytes"])
        yield ids, texts, np.frombuffer(body, np.uint8), np.concatenate([[0], np.cumsum(lengths)])


def _together(parts: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def cut_out(docs: DataFrame, replies: DataFrame, plan: Plan) -> DataFrame:
    """Covered bytes, contexts and single windows (``_COVER`` rows) from the replies and the texts.

    The slices of a bucket of ids are put together before they are sent: a row per bucket, not per slice and bucket.
    Contexts go once per text, with the places of all their occurrences (``hi`` counts them).
    """
    held, seed_buckets, doc_buckets = plan.heavy, plan.seed_buckets, plan.doc_buckets
    # A told run has LENGTH - SEED + 1 windows at most.
    told_single = replies.agg(F.sum("singles")).first()[0] or 0
    single_buckets = max(1, told_single * (LENGTH - SEED + 1) // BUCKET_ANCHORS)

    def keys(ids: np.ndarray, name: np.ndarray) -> np.ndarray:
        return mix(ids.view(np.uint64) + _TAG) ^ mix(name)

    def cut(texts: pa.Table, told: pa.Table) -> pa.Table:
        key = keys(_numbers(told, "ids"), _numbers(told, "names", np.uint64))
        flags = np.frombuffer(_joined(told, "flags"), np.uint8)
        order = np.argsort(key)
        key, flags = key[order], flags[order]
        covers, contexts, places, bodies, windows = [], [], [], [], []
        for ids, hashes, data, offsets in _unpack(texts) if len(key) else ():
            row, lo, hi, seed, context, single = runs(data, offsets, held.value)
            own = keys(ids[row], np.where(single, context, _names(seed, context)))
            at = np.minimum(np.searchsorted(key, own), len(key) - 1)
            flag = np.where(key[at] == own, flags[at].astype(np.int64), -1)
            begin = offsets[row]
            some = np.flatnonzero(flag == COVER)
            if len(some):
                # Merged per text, in order.
                some = some[np.lexsort((lo[some], row[some]))]
                end = np.maximum.accumulate(hi[some] + LENGTH)
                fresh = np.r_[True, (row[some][1:] != row[some][:-1]) | (lo[some][1:] > end[:-1])]
                starts = np.flatnonzero(fresh)
                stops = end[np.append(starts[1:], len(some)) - 1]
                first = some[starts]
                covers.append((ids[row[first]], hashes[row[first]], lo[first] - begin[first], stops - begin[first]))
            some = np.flatnonzero(flag == CONTEXT)
            if len(some):
                some = some[np.lexsort((lo[some], context[some], seed[some], row[some]))]
                new = np.ones(len(some), bool)
                new[1:] = False
                for x in (row, seed, context):
                    new[1:] |= x[some][1:] != x[some][:-1]
                first, counts = some[new], np.diff(np.append(np.flatnonzero(new), len(some)))
                end = hi[first] + LENGTH
                contexts.append((ids[row[first]], hashes[row[first]], seed[first], counts, end - lo[first]))
                places.append((lo - begin)[some])
                bodies.append(data[_windows(lo[first], end - 1)])
            some = np.flatnonzero(flag == SINGLE)
            if len(some):
                single, owner = _windows(lo[some], hi[some]), np.repeat(row[some], hi[some] - lo[some] + 1)
                window = span_hashes(prefix_sums(data), single, single + LENGTH)
                windows.append((ids[owner], hashes[owner], single - offsets[owner], window))
        rows = _covers(*_together(covers), doc_buckets) if covers else []
        if contexts:
            ids, hashes, seed, counts, width = _together(contexts)
            place, data = np.concatenate(places), np.concatenate(bodies)
            place_at, data_at = np.cumsum(counts) - counts, np.cumsum(width) - width
            for bucket, at in _split((mix(seed) % np.uint64(seed_buckets)).astype(np.int64), seed):
                lo = place[_windows(place_at[at], place_at[at] + counts[at] - 1)]
                body = data[_windows(data_at[at], data_at[at] + width[at] - 1)]
                rows.append(
                    (CONTEXT, bucket, *(x.tobytes() for x in (ids[at], hashes[at], lo, counts[at], seed[at], width[at], body)))
                )
        if windows:
            ids, hashes, place, window = _together(windows)
            for bucket, at in _split((mix(window) % np.uint64(single_buckets)).astype(np.int64)):
                numbers = (x[at].tobytes() for x in (ids, hashes, place))
                rows.append((SINGLE, -1 - bucket, *numbers, b"", window[at].tobytes(), b"", b""))
        return pa.Table.from_batches([_batch(_COVER, rows)])

    return store(
        packed(docs, plan).groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(cut, _sql(_COVER))
    )


def equal_windows(contexts: list[np.ndarray], owner: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, place) of the windows whose bytes also stand in a context of the group with a smaller owner.

    Contexts of a group are consecutive and become one string; strings of like length share a batch.
    """
    width = np.array([len(c) for c in contexts], np.int64)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    bounds = np.append(starts, len(contexts))
    total = np.add.reduceat(width + 1, starts)
    order = np.argsort(total, kind="stable")
    found_context, found_place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b + 1 - a) * (total[order[b]] + 1) <= BATCH_CELLS:
            b += 1
        some = order[a:b]
        a = b
        lengths = total[some]  # the last separator of a string is its only 0
        symbols = np.zeros((len(some), int(lengths.max())), np.int32)
        context_of = np.full(symbols.shape, -1, np.int64)
        place_of = np.zeros(symbols.shape, np.int64)
        for r, g in enumerate(some.tolist()):
            members = np.arange(bounds[g], bounds[g + 1])
            symbols[r, : lengths[r]] = np.concatenate([x for m in members for x in (contexts[m].astype(np.int32) + 2, [1])])
            symbols[r, lengths[r] - 1] = 0
            w = width[members] + 1
            context_of[r, : lengths[r]] = np.repeat(members, w)
            place_of[r, : lengths[r]] = np.arange(lengths[r]) - np.repeat(np.cumsum(w) - w, w)
        arrays = suffix_arrays(symbols, lengths)
        r, c = np.nonzero(np.arange(symbols.shape[1]) < lengths[:, None])
        at = r * symbols.shape[1] + arrays[r, c]
        context, place = context_of.ravel()[at], place_of.ravel()[at]
        whole = place + LENGTH <= width[context]
        at, context, place, r = at[whole], context[whole], place[whole], r[whole]
        if not len(at):
            continue
        flat = symbols.ravel()
        same = r[1:] == r[:-1]
        for i in range(LENGTH):
            rest = np.flatnonzero(same)
            same[rest] = flat[at[1:][rest] + i] == flat[at[:-1][rest] + i]
        first = np.flatnonzero(np.r_[True, ~same])
        least = np.repeat(np.minimum.reduceat(owner[context], first), np.diff(np.append(first, len(at))))
        covered = owner[context] > least
        found_context.append(context[covered])
        found_place.append(place[covered])
    return np.concatenate(found_context), np.concatenate(found_place)


def compare(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Covered bytes (``_COVER`` rows) from the contexts and single windows."""
    doc_buckets = plan.doc_buckets

    def sort(table: pa.Table) -> pa.Table:
        ids, texts, lo = (_numbers(table, n) for n in ("ids", "texts", "lo"))
        seed = _numbers(table, "seeds", np.uint64)
        if table.column("bucket")[0].as_py() < 0:
            order = np.lexsort((ids, seed))
            new = np.r_[True, seed[order][1:] != seed[order][:-1]]
            least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            covered = order[ids[order] > least]
            rows = _covers(ids[covered], texts[covered], lo[covered], lo[covered] + LENGTH, doc_buckets)
        else:
            width, counts = _numbers(table, "lengths"), _numbers(table, "hi")
            places = np.cumsum(counts) - counts
            data = np.frombuffer(_joined(table, "data"), np.uint8)
            starts = np.cumsum(width) - width
            order = np.lexsort((ids, seed))
            contexts = [data[starts[i] : starts[i] + width[i]] for i in order.tolist()]
            context, place = equal_windows(contexts, ids[order], seed[order])
            # Windows that touch are merged; what is covered is so at every occurrence of the context.
            by = np.lexsort((place, context))
            context, place = context[by], place[by]
            fresh = np.ones(len(context), bool)
            fresh[1:] = (context[1:] != context[:-1]) | (place[1:] > place[:-1] + LENGTH)
            first, last = np.flatnonzero(fresh), np.flatnonzero(np.append(fresh[1:], True)[: len(fresh)])
            covered, n = order[context[first]], counts[order[context[first]]]
            begin = lo[_windows(places[covered], places[covered] + n - 1)]
            end = begin + np.repeat(place[last] + LENGTH, n)
            begin += np.repeat(place[first], n)
            rows = _covers(np.repeat(ids[covered], n), np.repeat(texts[covered], n), begin, end, doc_buckets)
        return pa.Table.from_batches([_batch(_COVER, rows)])

    rows = pieces.filter(F.col("kind") != COVER)
    return rows.groupBy("bucket").applyInArrow(sort, _sql(_COVER))


def _key(ids: np.ndarray, texts: np.ndarray) -> np.ndarray:
    return mix(ids.view(np.uint64)) ^ mix(texts.view(np.uint64) + _TAG)


def remove_repeats(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the ``kept`` bytes if asked for."""
    plan = Plan(docs)
    pieces = cut_out(docs, match_runs(docs, plan), plan)
    covers = pieces.filter(F.col("kind") == COVER).unionByName(compare(pieces, plan))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_kept else [])]

    def finish(texts: pa.Table, covers: pa.Table) -> pa.Table:
        key = _key(_numbers(covers, "ids"), _numbers(covers, "texts"))
        order = np.argsort(key, kind="stable")
        key, lo, hi = key[order], _numbers(covers, "lo")[order], _numbers(covers, "hi")[order]
        out = [[] for _ in names]
        for ids, hashes, data, offsets in _unpack(texts):
            own = _key(ids, hashes)
            a, b = np.searchsorted(key, own, "left"), np.searchsorted(key, own, "right")
            at = _windows(a, b - 1)
            begin = np.repeat(offsets[:-1], b - a)
            steps = np.zeros(len(data) + 1, np.int64)
            np.add.at(steps, lo[at] + begin, 1)
            np.add.at(steps, hi[at] + begin, -1)
            gone = np.cumsum(steps[:-1]) > 0
            starts = gone.copy()
            starts[1:] &= ~gone[:-1]
            edge = offsets[:-1][np.diff(offsets) > 0]
            starts[edge] = gone[edge]
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (gone, starts)]
            out[0].append(pa.array(ids, mask=ids == NO_ID))
            out[1].append(pa.array(np.diff(offsets)))
            out[2].append(pa.array(np.diff(sums[0][offsets])))
            out[3].append(pa.array(np.diff(sums[1][offsets])))
            kept = [data[x:y][~gone[x:y]].tobytes() for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
            out[4].append(pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
            if with_kept:
                out[5].append(pa.array(kept, pa.binary()))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        return pa.table({n: pa.chunked_array(c, k) for n, c, k in zip(names, out, kinds, strict=False)})

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_kept
    return packed(docs, plan).groupBy("bucket").cogroup(covers.groupBy("bucket")).applyInArrow(finish, schema)

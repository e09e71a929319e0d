"""Exact SentencePiece BPE encoding by backtracking, and decoding.

``encode(docs, model)`` adds two columns: ``tokens`` (the ids as little-endian
unsigned 32-bit integers, begin and end id included) and ``decoded`` (what the
library's ``decode`` makes of these ids).  The library normalises the text and
decodes; the ids are found here:

1. The text is cut where no piece of the vocabulary can cross: before a space
   mark that follows another character, between characters of classes that no
   piece joins, and around characters that no longer piece has.
2. An Aho-Corasick automaton finds all pieces of a cut at once.  From each place
   on the longest is tried first.
3. A piece may follow another if merging the two pieces' characters anew, best
   score first and leftmost of equals, gives just these two pieces.  A text's
   encoding is the only sequence in which all neighbours fit.
4. Where no piece fits, the place is marked in a bit field of failed places and
   the search steps back.  A place is reached by one sequence only, so a failed
   one is never tried again.

Equal cuts of a task are encoded once (a bounded memory, emptied when full).

Defined cases.  Null and empty texts: begin and end id only.  Characters outside
the vocabulary: their UTF-8 bytes' ids, or the unknown id (once for a run) where
the model has no byte pieces.  Very long texts are cut in blocks of about a
million characters before they are searched; a text without any cut is searched
in windows; ids and decoded text of one text must fit in a task (some 50 bytes a
token).  Repeated rows are encoded each; an empty table gives an empty table;
columns called ``tokens`` or ``decoded`` are replaced, all others are kept.
Models whose pieces carry the space mark behind a word raise a ValueError.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schoolatlas.llm.common import ship, slices

ship(__name__)

SPACE = "▁"
#: Cuts kept in memory, and the longest that is kept.
MOST_CUTS, LONGEST_CUT = 400_000, 64
#: Characters of a block of text, and of a window of the automaton.
BLOCK, WINDOW = 1 << 20, 1 << 12


def character_classes(pieces: list[str]) -> list[str]:
    """Characters that pieces join, directly or through others, in classes of two or more."""
    parent: dict[str, str] = {}

    def top(c: str) -> str:
        while parent.setdefault(c, c) != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    for piece in pieces:
        for left, right in zip(piece, piece[1:]):
            if right == SPACE and left != SPACE:
                raise ValueError("pieces with the space mark behind a word can't be cut into words")
            if left != SPACE:
                parent[top(left)] = top(right)
    classes: dict[str, list[str]] = {}
    for c in list(parent):
        classes.setdefault(top(c), []).append(c)
    return ["".join(sorted(c)) for c in classes.values()]


class Encoder(dict):
    """Cut -> ids as bytes; encodes what it doesn't hold."""

    def __init__(self, model: bytes) -> None:
        import ahocorasick
        import sentencepiece

        super().__init__()
        self.model = model
        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        special = (library.is_control, library.is_byte, library.is_unknown, library.is_unused)
        self.ids = {
            library.id_to_piece(i): i for i in range(library.get_piece_size()) if not any(kind(i) for kind in special)
        }
        self.score = {piece: library.get_score(i) for piece, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes = library.is_byte(self.bytes[0])
        self.found = ahocorasick.Automaton()
        for piece in self.ids:
            self.found.add_word(piece, (len(piece) - 1, piece))
        self.found.make_automaton()
        classes = "|".join(f"[{re.escape(c)}]+" for c in character_classes(list(self.ids)))
        self.cuts = re.compile(f"{SPACE}*(?:{classes}|[^{SPACE}])|{SPACE}+" if classes else f"{SPACE}+|[^{SPACE}]", re.DOTALL)
        self.border = re.compile(f"[^{SPACE}](?={SPACE})")
        self.pairs: dict[tuple[str, str], bool] = {}

    def __reduce__(self) -> tuple:
        return Encoder, (self.model,)

    def merged(self, text: str) -> list[str]:
        """The text's pieces by merging: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, left: str, right: str) -> bool:
        """True if merging both pieces' characters anew gives these two pieces."""
        if len(self.pairs) >= MOST_CUTS:
            self.pairs.clear()
        fits = self.pairs[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return fits

    def matches(self, text: str, window: int) -> list[list[str]]:
        """For every place of a window the pieces that start there, longest first."""
        part = text[window * WINDOW : (window + 1) * WINDOW + self.longest] if len(text) > WINDOW else text
        here: list[list[str]] = [[] for _ in part]
        for end, (before, piece) in self.found.iter(part):
            here[end - before].append(piece)
        for pieces in here:
            if len(pieces) > 1:
                pieces.reverse()  # the automaton reports by end: shorter ones first
        return here

    def search(self, text: str) -> list[str]:
        """The only sequence of pieces whose neighbours all fit; characters outside the vocabulary stand alone."""
        windows: dict[int, list[list[str]]] = {}
        failed = bytearray((len(text) >> 3) + 1)
        path: list[tuple[str, int, int]] = []
        known = self.pairs.get
        place, choice, last, number = 0, 0, "", -1
        here: list[list[str]] = []
        length = len(text)
        while place < length:
            if place // WINDOW != number:
                number = place // WINDOW
                if number not in windows:
                    if len(windows) > 3:
                        windows.clear()
                    windows[number] = self.matches(text, number)
                here = windows[number]
            options = here[place % WINDOW] or [text[place]]
            for choice in range(choice, len(options)):
                piece = options[choice]
                end = place + len(piece)
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                fits = known((last, piece))
                if fits or fits is None and self.fit(last, piece):
                    path.append((piece, place, choice))
                    place, choice, last = end, 0, piece
                    break
            else:
                failed[place >> 3] |= 1 << (place & 7)
                _, place, choice = path.pop()
                choice += 1
                last = path[-1][0] if path else ""
        return [piece for piece, _, _ in path]

    def __missing__(self, cut: str) -> bytes:
        out: list[int] = []
        for piece in self.search(cut):
            number = self.ids.get(piece)
            if number is not None:
                out.append(number)
            elif self.has_bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.library.unk_id())
        ids = np.array(out, "<u4").tobytes()
        if len(cut) <= LONGEST_CUT:
            if len(self) >= MOST_CUTS:
                self.clear()
            self[cut] = ids
        return ids

    def blocks(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > BLOCK:
            border = self.border.search(text, start + BLOCK)
            if not border:
                break
            yield text[start : border.end()]
            start = border.end()
        yield text[start:]

    def encode(self, text: str) -> bytes:
        """All ids of a text, begin and end id included."""
        of = self.__getitem__
        parts = [b"".join(map(of, self.cuts.findall(block))) for block in self.blocks(self.library.normalize(text))]
        body = b"".join(parts)
        if not self.has_bytes:  # a run of unknown characters is one id
            ids = np.frombuffer(body, "<u4")
            unknown = ids == self.library.unk_id()
            body = ids[~(unknown & np.r_[False, unknown[:-1]])].tobytes()
        return np.uint32(self.library.bos_id()).tobytes() + body + np.uint32(self.library.eos_id()).tobytes()

    def decode(self, tokens: bytes) -> str:
        return self.library.decode(np.frombuffer(tokens, "<u4").tolist())


def encode(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """The rows with ``tokens`` and ``decoded``; ``model`` holds the bytes of a SentencePiece BPE model."""
    kept = [c for c in docs.columns if c not in ("tokens", "decoded")]
    rows = docs.select(F.struct(*kept).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("tokens", T.BinaryType()), T.StructField("decoded", T.StringType())])

    shared = docs.sparkSession.sparkContext.broadcast(Encoder(model))  # as the model; a worker's tasks share its memory

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for batch in batches:
            lengths = pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for start, end in slices(lengths):
                part = batch.slice(start, end - start)
                tokens = [encoder.encode(text) for text in part.column("text").to_pylist()]
                decoded = [encoder.decode(ids) for ids in tokens]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(tokens, pa.binary()), pa.array(decoded, pa.string())],
                    names=["row", "tokens", "decoded"],
                )

    return rows.mapInArrow(run, schema).select("row.*", "tokens", "decoded")

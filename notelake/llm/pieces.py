"""SentencePiece encoding and decoding (merge-type models with byte fallback), exact, by backtracking."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: Words and token pairs whose results a worker keeps, and most characters of such a word: some 60 MB at most.
WORDS_KEPT, PAIRS_KEPT, LONGEST_KEPT = 120_000, 200_000, 48
#: Rows of an output batch.
BATCH = 500


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


def _refuse_others(model: bytes) -> None:
    """An error for models that encode in another way: only merge-type ones with byte fallback and plain spaces, without a normaliser, are built here."""
    parts = list(_message(model))
    trainer, normalizer = (dict(_message(next((v for n, v in parts if n == k), b""))) for k in (2, 3))
    if trainer.get(3, 1) != 2:
        raise ValueError("the model isn't of the merge type")
    if trainer.get(24, 0) or normalizer.get(2, b"") or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("the model has a normaliser, or treats spaces in another way")
    if any(dict(_message(v)).get(3, 1) in (4, 5) for n, v in parts if n == 1):
        raise ValueError("the model has user-defined or unused pieces")


class Pieces:
    """Vocabulary of a model file and the encoder of single words over it."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        _refuse_others(model.serialized_model_proto())
        self.names = [model.id_to_piece(i) for i in range(len(model))]
        self.bytes = {i: int(p[1:-1], 16) for i, p in enumerate(self.names) if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        plain = [i for i, p in enumerate(self.names) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {self.names[i]: i for i in plain}
        self.rank = {self.names[i]: -model.get_score(i) for i in plain}
        self.raw = {p: array("i", [i]).tobytes() for p, i in self.ids.items()}
        self.end = model.eos_id()
        self.texts = [" \u2047 " if model.is_unknown(i) else p.replace(SPACE, " ") if p in self.ids else "" for i, p in enumerate(self.names)]
        self.table, self.is_byte = np.array(self.texts, dtype=object), np.array([i in self.bytes for i in range(len(self.names))])
        self.automaton = ahocorasick.Automaton()
        self.best: dict[str, str] = {"": ""}  # the longest piece that begins a beginning of a piece
        self.shorter: dict[str, str] = {}
        for p in sorted(self.ids):  # what begins a piece comes before it
            self.automaton.add_word(p, len(p))
            for k in range(1, len(p)):
                self.best.setdefault(p[:k], self.best[p[: k - 1]])
            inner = self.best[p[:-1]] or (p[0] if len(p) > 1 else "")
            if inner:
                self.shorter[p] = inner
            self.best[p] = p
        self.automaton.make_automaton()
        self.widest = max(map(len, self.ids))
        self.pairs: dict[tuple[str, str], bool] = {}
        # no piece goes on after a space that follows something else, so no merge crosses the start of a run of spaces
        apart = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else "(?s).+").findall
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.known, self.known_part = lru_cache(WORDS_KEPT)(self._word), lru_cache(WORDS_KEPT)(self._part)

    def merged(self, text: str) -> list[str]:
        """Merge characters pair by pair, best rank first and leftmost among equals. For short strings only."""
        parts = list(text)
        while len(parts) > 1:
            found = [(r, k) for k in range(len(parts) - 1) if (r := self.rank.get(parts[k] + parts[k + 1])) is not None]
            if not found:
                break
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """May `right` follow `left`? Only if merging both anew gives just these two; left may be empty."""
        if len(self.pairs) > PAIRS_KEPT:
            self.pairs.clear()
        ok = self.pairs[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return ok

    def longest(self, word: str, at: int) -> str:
        """The longest piece that begins at a place, or the character there."""
        tail = word[at : at + self.widest]
        return self.best[tail[: self.automaton.longest_prefix(tail)]] or tail[0]

    def word(self, word: str) -> bytes:
        return self.known(word) if len(word) <= LONGEST_KEPT else self._word(word)

    def part(self, word: str) -> bytes:
        return self.known_part(word) if len(word) <= LONGEST_KEPT else self._part(word)

    def _word(self, word: str) -> bytes:
        """Ids of a word, as the bytes of an array of int32; it is cut where no piece holds the two characters together."""
        parts, at = [], 0
        for k in range(1, len(word)):
            if word[k - 1 : k + 1] not in self.joined:
                parts.append(self.part(word[at:k]))
                at = k
        parts.append(self.part(word[at:]))
        return b"".join(parts)

    def _part(self, word: str) -> bytes:
        """Ids of a part of a word.

        At each place the longest piece is tried first, then shorter ones. A piece stands if it fits the one before it.
        If none does, the place is marked as failed and the last piece gives way. The pieces up to a place are the only
        encoding of what they cover, so a failed place fails for good: each is visited once.
        """
        pairs, shorter, failed = self.pairs, self.shorter, 0
        taken, at, before, end = [], 0, "", len(word)
        piece: str | None = self.longest(word, 0)
        while at < end:
            while piece:
                if not (failed and failed >> at + len(piece) & 1):
                    ok = pairs.get((before, piece))
                    if ok or ok is None and self.fits(before, piece):
                        break
                piece = shorter.get(piece)
            if piece:
                taken.append(piece)
                at += len(piece)
                before = piece
                if at < end:
                    piece = self.longest(word, at)
            else:
                failed |= 1 << at
                last = taken.pop()
                at -= len(last)
                before = taken[-1] if taken else ""
                piece = shorter.get(last)
        return b"".join([self.raw.get(p) or self.raw_of(p) for p in taken])

    def raw_of(self, piece: str) -> bytes:
        """The ids of the bytes of a character that is no piece."""
        return array("i", [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.word, self.words(SPACE + text.replace(" ", SPACE))))

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, spaces restored, the first one dropped; bytes that aren't UTF-8 become U+FFFD each."""
        parts = self.table[ids].tolist()
        if self.is_byte[ids].any():
            for a, b in _runs(self.is_byte[ids]):
                parts[a] = _utf8(bytes(self.bytes[i] for i in ids[a:b].tolist()))
        shown = np.flatnonzero([bool(x) for x in parts[:8]])
        if shown.size and parts[shown[0]].startswith(" ") and self.names[ids[shown[0]]] in self.ids:
            parts[shown[0]] = parts[shown[0]][1:]
        return "".join(parts)

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.array([self.decode(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.string())


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)


def _utf8(run: bytes) -> str:
    """Decode; each byte that begins no valid character becomes one U+FFFD."""
    out, k = [], 0
    while k < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[k : k + size].decode("utf-8"))
                k += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


@lru_cache(4)
def pieces(path: str) -> Pieces:
    """One per worker process."""
    return Pieces(path)


def encoded(docs: DataFrame, path: str, text: str = "text", to: str = "ids", end: bool = True, back: str | None = None) -> DataFrame:
    """The rows with the ids of the whole text in column `to` (array<int>), as sentencepiece's encode() gives them.

    With `end`, the model's end id follows. A null or empty text has no other ids. With `back`, the same pass decodes the ids to
    text in that column, as decoded() does. Other columns stay; those of the new names are replaced. The file at `path` must
    be there on every executor.
    """
    new = [to, *([back] if back else [])]
    docs = docs.drop(*[c for c in new if c in docs.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        tail = array("i", [p.end]).tobytes() if end else b""
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                got = [p.encode(t) + tail for t in batch.column(text).to_pylist()]
                ends = np.cumsum([0, *map(len, got)], dtype=np.int64) // 4
                flat = np.frombuffer(b"".join(got), np.int32)
                made = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
                if back:
                    made.append(p.decode_all(flat, ends))
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *new])

    kinds = [T.StructField(to, T.ArrayType(T.IntegerType())), *([T.StructField(back, T.StringType())] if back else [])]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *kinds]))


def decoded(docs: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the text of the ids in column `to`, as sentencepiece's decode() gives it. Null ids: empty text."""
    docs = docs.drop(to) if to in docs.columns else docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                col = batch.column(ids)
                texts = p.decode_all(col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, to])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(to, T.StringType())]))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id with the count and digests of encoding and decoding back."""
    both = encoded(docs.select("doc_id", "text"), path, back="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

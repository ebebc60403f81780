"""Vector bin packing of token sequences under three limits: tokens, segments, loss-bearing tokens.

Every task packs the rows that it reads, in one pass with a bounded pool: nothing is shuffled, no
key is brought together, and a task wastes at most its last sequence. A sequence is filled by the
dot-product heuristic: among the pool's items that fit, take the one whose demand has the greatest
dot product with the room left, each dimension as a share of its limit. What room is left when no
whole item fits is filled with the head of the largest item, if items may be cut.

A sequence's id holds the number of the task's partition, so ids are stable when a task is repeated
on the same partition; give the operator a table, or another input of stable partitions.

Defined cases: null or empty text is the document [end]. Equal rows are packed separately. Whole
examples that exceed a limit by themselves get no sequence (null), and are reported, not dropped.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwind.llm.texts import Batches

#: fixed value: the id that ends each document
END = 1
#: items that wait in a task's pool, and distinct words whose ids a worker remembers
_POOL, _REMEMBER = 512, 600_000
_SPACE_BITS = 33

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long, segment int"


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    #: as many as tokens: then it never binds, since a segment has one token at least
    segments: int = 2048
    loss: int = 2048


def _bytes_of_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones as they are, the
    rest, in order, from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of whole texts by a tokenizer file, with the ids of words remembered.

    A byte-level BPE never joins a character to a single space after it, so a text with no double
    spaces and no white space but spaces and line feeds may be cut before each space. Words not seen
    before are encoded by their ranks, which are the ids of the file's own byte-level vocabulary (its
    merges are numbered in order); all other texts, and those with an added token of the file, are
    encoded whole by the tokenizer itself.
    """

    #: fixed value: how a byte-level BPE of this kind cuts a text into pieces
    _PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    #: fixed value: white space beside space and line feed
    _OTHER = tuple(map(chr, (9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each task
        import tiktoken
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        special = self._model.get_added_tokens_decoder()
        # the tokenizer finds these in a text before all else, and so they are found on whole texts
        self._special = tuple(t.content for t in special.values())
        byte = _bytes_of_letters()
        ranks = {
            bytes(byte[c] for c in token): i for token, i in self._model.get_vocab().items() if i not in special
        }
        self._words = tiktoken.Encoding("words", pat_str=self._PIECES, mergeable_ranks=ranks, special_tokens={})
        self._known: dict[str, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, words: set[str]) -> None:
        encode = self._words.encode_ordinary
        self._known.update((w, array("I", encode(" " + w)).tobytes()) for w in words)

    def __call__(self, text: str) -> np.ndarray:
        if "  " in text or any(c in text for c in self._OTHER) or any(s in text for s in self._special):
            return self._encode(text)
        if len(self._known) > _REMEMBER:
            self._known = {}
        first, *rest = text.split(" ")
        found = list(map(self._known.get, rest))
        if None in found:
            self._learn({w for w, ids in zip(rest, found, strict=True) if ids is None})
            found = map(self._known.__getitem__, rest)
        return np.frombuffer(array("I", self._words.encode_ordinary(first)).tobytes() + b"".join(found), dtype="<u4")


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, so that a task starts with the words of the tasks before it."""
    return WordTokenizer(path)


@dataclass
class _Item:
    key: int
    ids: np.ndarray | None
    total: int
    start: int
    length: int
    loss: int


class Packer:
    """Fills sequences from a pool. `cut`: items may be divided, and then all their tokens bear loss."""

    def __init__(self, limits: Limits, cut: bool, first_id: int):
        self.limits, self.cut, self.next = limits, cut, first_id
        self.pool: list[_Item] = []
        self.held = 0  # tokens of the pool
        self.tokens, self.loss = (np.zeros(_POOL + limits.segments + 1) for _ in range(2))
        self.rows: list[tuple] = []

    def add(self, item: _Item) -> None:
        limits, most = self.limits, min(self.limits.tokens, self.limits.loss)
        if self.cut:
            while item.length >= most:
                self._emit([self._head(item, most)])
            if not item.length:
                return
        elif item.length > limits.tokens or item.loss > limits.loss:
            self.rows.append((item.key, item.start, item.length, None, item.total, None, None, item.loss, None))
            return
        at = len(self.pool)
        self.pool.append(item)
        self.tokens[at], self.loss[at] = item.length, item.loss
        self.held += item.length
        # a pool of short items waits until it can fill a sequence, by tokens or by segments
        while len(self.pool) >= _POOL and (self.held >= limits.tokens or len(self.pool) >= _POOL + limits.segments):
            self._fill()

    def flush(self) -> None:
        while self.pool:
            self._fill()

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows

    def _head(self, item: _Item, n: int) -> _Item:
        head = _Item(item.key, item.ids, item.total, item.start, n, n)
        item.start, item.length, item.loss = item.start + n, item.length - n, item.loss - n
        return head

    def _remove(self, at: int) -> _Item:
        item, last = self.pool[at], self.pool.pop()
        self.held -= item.length
        if at < len(self.pool):
            self.pool[at] = last
            self.tokens[at], self.loss[at] = self.tokens[len(self.pool)], self.loss[len(self.pool)]
        return item

    def _fill(self) -> None:
        most = self.limits
        room, loss_room, chosen = most.tokens, most.loss, []
        while room and loss_room and len(chosen) < most.segments and self.pool:
            tokens, loss = self.tokens[: len(self.pool)], self.loss[: len(self.pool)]
            # an item's share of the segment limit is the same for all and does not change the choice
            gain = tokens * (room / most.tokens**2) + loss * (loss_room / most.loss**2)
            gain[(tokens > room) | (loss > loss_room)] = -1
            best = int(gain.argmax())
            if gain[best] < 0:
                if not self.cut:
                    break
                best = int(tokens.argmax())
                piece = self._head(self.pool[best], min(room, loss_room))
                self.held -= piece.length
                tokens[best], loss[best] = self.pool[best].length, self.pool[best].loss
            else:
                piece = self._remove(best)
            chosen.append(piece)
            room, loss_room = room - piece.length, loss_room - piece.loss
        self._emit(chosen)

    def _emit(self, pieces: list[_Item]) -> None:
        offset = 0
        for segment, p in enumerate(pieces):
            crc = zlib.crc32(p.ids[p.start : p.start + p.length].tobytes()) if p.ids is not None else None
            self.rows.append((p.key, p.start, p.length, crc, p.total, self.next, offset, p.loss, segment))
            offset += p.length
        self.next += 1


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64()] * 8 + [pa.int32()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _first_id() -> int:
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << _SPACE_BITS


def pack_documents(docs: DataFrame, tokenizer: str, limits: Limits | None = None) -> DataFrame:
    """One row per piece. Documents are cut freely; `start` counts the document's ids before the piece.

    `tokenizer` is the path of a tokenizer file that every executor has.
    """
    limits = limits or Limits()

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        encode, packer = _tokenizer(tokenizer), Packer(limits, True, _first_id())
        end = np.array([END], dtype="<u4")
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([encode(text or ""), end])
                packer.add(_Item(key, ids, len(ids), 0, len(ids), len(ids)))
            yield _batch(packer.taken())
        packer.flush()
        yield _batch(packer.taken())

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def pack_examples(examples: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Packs whole examples (doc_id, tokens, loss_tokens), such as instruction data, without cutting.

    Null counts are 0. Returns the columns of pieces; ids_crc32 is null.
    """
    limits = limits or Limits()
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, False, _first_id())
        for batch in batches:
            for key, tokens, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packer.add(_Item(key, None, tokens, 0, tokens, loss))
            yield _batch(packer.taken())
        packer.flush()
        yield _batch(packer.taken())

    return examples.select(F.col("doc_id").cast("long"), number("tokens"), number("loss_tokens")).mapInArrow(run, PIECES)

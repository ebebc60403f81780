"""Token counts of every prefix of a text, by dynamic programming over a BPE vocabulary.

For a vocabulary whose merges go by score, the tokens of a prefix end with exactly one piece t for
which the piece before it and t stay apart when both are encoded together; what stands before t is
the encoding of that shorter prefix. So, with p the length of t,

    count(i) = count(i - p) + 1,   last(i) = t

is the exact token count of the first i code points, not an estimate, for every i. It is not
monotonic: a longer prefix may merge into fewer tokens. The table of counts then answers how many
tokens any prefix has and where a text must end to keep to a budget, and no text is encoded again.

A piece never joins a character to a space after it, and characters that are part of no longer piece
never merge; a text is cut at both. The deltas of pieces of text seen before are remembered by each
worker, up to a fixed number.

Whole texts are read, one at a time; nothing is shuffled. Defined cases: null text is empty; the empty
text has no tokens; repeated rows are counted alike; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwind.llm.texts import arrow_pass

#: pieces of text and pairs of tokens that a worker remembers, and the longest such piece of text
_REMEMBER, _LONGEST = 300_000, 64
#: code points that are cut up at once
_AT_ONCE = 1 << 20
#: fixed value: how the vocabulary writes a space
_SPACE = "▁"


class PrefixCounter:
    """Counts for the model file of a BPE vocabulary with scores and byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self._score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        joined = sorted({c for piece in self._score if len(piece) > 1 for c in piece} - {_SPACE})
        word = "[" + "".join(map(re.escape, joined)) + "]"
        self._cut = re.compile(f"{_SPACE}*{word}+|{_SPACE}+|.", re.DOTALL)
        # a character of longer pieces that is no piece itself is written in bytes
        self._cost = {c: len(c.encode()) for c in joined if c not in self._score}
        self._ending = ahocorasick.Automaton()
        for piece in {*self._score, *self._cost}:
            self._ending.add_word(piece, piece)
        self._ending.make_automaton()
        self._known: dict[str, bytes] = {}
        self._apart: dict[tuple[str, str], bool] = {}

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best-scored neighbours merge first, of equal ones the left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self._score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stay_apart(self, before: str, piece: str) -> bool:
        """Whether `piece` is a token and ends the encoding of both; with nothing before, of itself."""
        key = (before, piece)
        found = self._apart.get(key)
        if found is None:
            if len(self._apart) >= _REMEMBER:
                self._apart.clear()
            parts = self._merged(before + piece)
            found = self._apart[key] = parts == ([before, piece] if before else [piece])
        return found

    def _deltas(self, part: str) -> bytes:
        """What each code point of a part adds to the count."""
        if len(part) == 1 and part not in self._score:
            return array("i", [len(part.encode("utf-8", "surrogatepass"))]).tobytes()
        counts, last, apart = [0] * (len(part) + 1), [""] * (len(part) + 1), self._apart
        # all pieces that end at a place, place by place; just one of them ends the encoding there
        for end, piece in self._ending.iter(part):
            end += 1
            if last[end]:
                continue
            start = end - len(piece)
            fits = apart.get((last[start], piece))
            if fits or fits is None and self._stay_apart(last[start], piece):
                last[end], counts[end] = piece, counts[start] + self._cost.get(piece, 1)
        return array("i", map(sub, counts[1:], counts)).tobytes()

    def _delta_of(self, part: str) -> bytes:
        found = self._known.get(part)
        if found is None:
            found = self._deltas(part)
            if len(part) <= _LONGEST:
                if len(self._known) >= _REMEMBER:
                    self._known = {}
                self._known[part] = found
        return found

    def _stretches(self, text: str):
        """The text in stretches that end before a space, so that a long text is not cut up at once."""
        start = 0
        while start < len(text):
            end = start + _AT_ONCE
            while end < len(text) and not (text[end] == _SPACE and text[end - 1] != _SPACE):
                end = next_space if (next_space := text.find(_SPACE, end + 1)) >= 0 else len(text)
            yield text[start:end]
            start = end

    def counts(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for i from 0 to the text's length."""
        if not text:
            return np.zeros(1, dtype=np.int32)
        # one space goes before every text and has no code point of its own
        spaced = _SPACE + text.replace(" ", _SPACE)
        deltas = [b"".join(map(self._delta_of, self._cut.findall(s))) for s in self._stretches(spaced)]
        found = np.cumsum(np.frombuffer(b"".join(deltas), dtype=np.int32), dtype=np.int32)
        found[0] = 0
        return found


@lru_cache(maxsize=1)
def _counter(path: str) -> PrefixCounter:
    """One for each Python worker, so that a task starts with what the tasks before it learned."""
    return PrefixCounter(path)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _n_bytes(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass"))


def prefix_table(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, and `counts`: the tokens of every prefix, by code points from 0 on.

    `model` is the path of a model file that every executor has. Write the table to ask it often.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counter = _counter(model)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = [counter.counts(t) for t in texts]
            ends = np.cumsum([0, *map(len, counts)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, dtype=np.int32), *counts])
            columns = [
                batch.column(0),
                pa.array(map(_n_bytes, texts), pa.int64()),
                pa.array([int(c[-1]) for c in counts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "counts"])

        return step

    return arrow_pass(_narrow(docs), "doc_id long, n_bytes long, n_tokens long, counts array<int>", make, rows=64)


def tokens_before(at: Column | str, counts: str = "counts") -> Column:
    """Tokens of the first `at` code points, of the whole text beyond its end, 0 below its start."""
    at = F.col(at) if isinstance(at, str) else at
    return F.get(counts, F.least(F.greatest(at, F.lit(0)), F.size(counts) - 1).cast("int"))


def longest_within(budget: int, counts: str = "counts") -> Column:
    """Code points of the longest prefix that has at most `budget` tokens; null for a negative budget."""
    fits = F.transform(F.reverse(counts), lambda c: c <= budget)
    at = F.array_position(fits, True)
    return F.when(at > 0, F.size(counts) - at).cast("long")


def count(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens), and
    fit_chars, the code points of its longest prefix with at most `limit` tokens."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counter, rows = _counter(model), []
            for text in batch.column(1).to_pylist():
                counts = counter.counts(text or "")
                n = int(counts[-1])
                fit = len(counts) - 1 - (int(np.argmax(counts[::-1] <= limit)) if n > limit else 0)
                rows.append((_n_bytes(text or ""), n, n > limit, fit))
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

        return step

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return arrow_pass(_narrow(docs), schema, make)


def truncated(docs: DataFrame, model: str, limit: int) -> DataFrame:
    """The documents with each text cut to its longest prefix of at most `limit` tokens; other columns,
    and texts that fit, are unchanged."""
    schema = docs.schema
    at = schema.names.index("text")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counter, out = _counter(model), []
            for text in batch.column(at).to_pylist():
                if text:
                    text = text[: int(np.flatnonzero(counter.counts(text) <= limit)[-1])]
                out.append(text)
            columns = [pa.array(out, c.type) if i == at else c for i, c in enumerate(batch.columns)]
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return step

    return arrow_pass(docs, schema, make)

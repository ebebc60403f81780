"""What the operators share: words, text statistics, Arrow passes over whole texts."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwind.session import materialize

#: fixed value: a word is a run of anything but space and the five ASCII line and tab characters
WORD = r"[^\x20\x09-\x0D]+"

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file on this machine; executors have the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def whole(text: Column | str) -> Column:
    """The text as a string; null is the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key written as text, modulo `modulus`; -1 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus, F.lit(-1))


def with_row_key(docs: DataFrame, purpose: str) -> DataFrame:
    """The rows with a key of their own, `__row`; written, so that it stays the same in every pass."""
    return materialize(docs.withColumn("__row", F.monotonically_increasing_id()), purpose)


def words_of(text: str) -> list[bytes]:
    """UTF-8 words. bytes.split() cuts at exactly the six characters that WORD excludes."""
    return text.encode("utf-8", "surrogatepass").split()


def lower_words(text: str) -> list[bytes]:
    """As words_of, with A-Z lower-cased and no other letter touched."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def slices(batches: Batches, rows: int) -> Batches:
    """The batches' rows in pieces of at most `rows`, so that what is made of one stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def arrow_pass(
    df: DataFrame,
    schema: str | T.StructType,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    rows: int = 1024,
) -> DataFrame:
    """Applies a function to all rows, at most `rows` at once. `make` runs once in each task."""

    def run(batches: Batches) -> Batches:
        step = make()
        for batch in slices(batches, rows):
            yield step(batch)

    return df.mapInArrow(run, schema)


# --- statistics of one text, used by the quality rules and the quality classifier

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGIT = b"0123456789"
_MARK = b"!?"
_STOP = b".,;:"
_OTHER = b"\"'()/\\-_=+@~^`"
#: fixed value: the symbols that the base rules count
SYMBOLS = b"#*$%&|<>"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHAPE = (
    "symbols_per_word",
    "bars_per_word",
    "dup_line_share",
    "repeat_share",
    "word_length",
    "upper_share",
    "digit_share",
    "mark_share",
    "stop_share",
    "other_share",
    "wide_share",
    "distinct_share",
    "same_next_share",
    "short_word_share",
    "log_words",
    "words_per_line",
)


def _without(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = np.zeros(len(words), dtype=bool)
    at = np.fromiter((seen[w] > 1 for w in windows), dtype=bool, count=len(windows))
    for shift in range(3):
        covered[shift : shift + len(windows)] |= at
    return int(covered.sum())


def repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [x for x in text.encode("utf-8", "surrogatepass").split(b"\n") if x.split()]
    return len(lines), len(lines) - len(set(lines))


def statistics(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """(BASE, SHAPE) of one whole text. Shares of an empty text are 0."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    lines, doubles = repeated_lines(text)
    symbols, repeats = _without(data, SYMBOLS), repeated_words(words)
    # white space is one byte and one code point, so what is left of the text are word characters
    space = len(data) - sum(map(len, words))
    base = (n, len(text) - space, symbols, doubles, repeats)
    if not n:
        return base, (0.0,) * len(SHAPE)
    chars = max(1, len(text) - space)
    shape = (
        symbols / n,
        data.count(b"|") / n,
        doubles / max(1, lines),
        repeats / n,
        chars / n,
        _without(data, _UPPER) / chars,
        _without(data, _DIGIT) / chars,
        _without(data, _MARK) / n,
        _without(data, _STOP) / n,
        _without(data, _OTHER) / n,
        (len(data) - len(text)) / chars,
        len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(len(w) <= 3 for w in words) / n,
        float(np.log1p(n)),
        n / max(1, lines),
    )
    return base, shape

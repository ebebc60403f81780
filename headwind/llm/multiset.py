"""Document fingerprints by a homomorphic multiset hash. DataFrame operations only.

Every paragraph (line) is hashed to a wide vector of integers, and a text's fingerprint is the sum of
its paragraphs' vectors modulo powers of two. So the order of paragraphs does not matter, and a
paragraph is inserted or deleted by adding or subtracting its vector. A vector has two parts:

- identity: 16 lanes modulo 2^32, each with a hash of its own of the whole paragraph; equal sums mean
  equal multisets of paragraphs but for a chance of about 2^-32 for each lane.
- likeness: each run of words of the paragraph, cut by content, adds a hashed bit to each of 126 lanes, kept
  modulo 2^21, three to a number modulo 2^62. The centred lanes of two texts have a cosine near that
  of their multisets of runs, with an error of about 0.09; it is cut off to 0..1. A text of more than
  a million runs wraps its lanes, which only blurs its likeness.

Defined cases: null text is empty. Two texts without words have likeness 1 if their fingerprints are
equal, else 0. Rows that share a doc_id share their place in the order; as "next document" such an
id stands for its least text. A row without doc_id has no next document. With one document, the next
one is itself. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwind.llm.texts import WORD, whole
from headwind.session import materialize

_IDENTITY, _HASHES, _STEPS, _WIDTH = 16, 2, 21, 21
#: up to 8 words of one line, ended by the first word of at most three characters: where a run ends
#: depends on the words, not on their places, so a word that comes in changes the run around it only
_RUN = rf"(?:{WORD[:-1]}{{4,}}+[\x20\x09\x0B-\x0D]++){{0,7}}{WORD}+"
_WORD32, _WORD62 = (1 << 32) - 1, (1 << 62) - 1
#: the lowest bit of each of the three lanes in a number
_LANES = sum(1 << (_WIDTH * k) for k in range(3))


def _big(n: int) -> Column:
    return F.lit(n).cast("long")


# The lane comes first in every hash: it seeds that of the paragraph. The other way round all lanes would
# be made from one number of 64 bits, and paragraphs that share it would agree in all of them.
# lambdas of higher-order functions may have no other parameters, so each is made by a function


def _seeded(i: int) -> Callable[[Column], Column]:
    return lambda run: F.xxhash64(F.lit(i), run)


def _plus_hash(i: int) -> Callable[[Column, Column], Column]:
    return lambda total, p: (total + F.xxhash64(F.lit(i), p).bitwiseAND(_big(_WORD32))).bitwiseAND(_big(_WORD32))


def _plus_bits(s: int) -> Callable[[Column, Column], Column]:
    """Bits s, s + 21 and s + 42 of a hash, added to three lanes."""
    return lambda total, h: total.bitwiseAND(_big(_WORD62)) + F.shiftrightunsigned(h, s).bitwiseAND(_big(_LANES))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`: struct(identity array, runs, likeness array) of the text column."""
    zero = _big(0)
    paragraphs, runs, hashes = f"__{out}_p", f"__{out}_r", [f"__{out}_h{i}" for i in range(_HASHES)]
    df = df.withColumn(paragraphs, F.split(text, "\n")).withColumn(runs, F.regexp_extract_all(text, F.lit(_RUN), 0))
    df = df.withColumns({h: F.transform(runs, _seeded(i)) for i, h in enumerate(hashes)})
    identity = [F.aggregate(paragraphs, zero, _plus_hash(i)) for i in range(_IDENTITY)]
    likeness = [F.aggregate(h, zero, _plus_bits(s)) for h in hashes for s in range(_STEPS)]
    value = F.struct(
        F.array(*identity).alias("identity"), F.size(hashes[0]).cast("long").alias("runs"), F.array(*likeness).alias("likeness")
    )
    return df.withColumn(out, value).drop(paragraphs, runs, *hashes)


def written(fingerprint: str) -> Column:
    """The fingerprint as one string of hex digits."""
    lanes = F.transform(f"{fingerprint}.identity", lambda x: F.lpad(F.hex(x), 8, "0"))
    more = F.transform(F.concat(F.array(f"{fingerprint}.runs"), f"{fingerprint}.likeness"), lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.lower(F.concat(F.array_join(lanes, ""), F.array_join(more, "")))


def _inner(a: str, b: str) -> Column:
    """Inner product of the centred lanes."""
    lane = lambda x, k: F.shiftright(x, _WIDTH * k).bitwiseAND(_big((1 << _WIDTH) - 1))

    def three(x: Column, y: Column) -> Column:
        parts = [
            (2 * lane(x, k) - F.col(f"{a}.runs")).cast("double") * (2 * lane(y, k) - F.col(f"{b}.runs")).cast("double")
            for k in range(3)
        ]
        return parts[0] + parts[1] + parts[2]

    products = F.zip_with(f"{a}.likeness", f"{b}.likeness", three)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def likeness(a: str, b: str) -> Column:
    """Cosine of two fingerprints' likeness lanes, between 0 and 1; 1 for equal fingerprints."""
    norm = F.sqrt(_inner(a, a)) * F.sqrt(_inner(b, b))
    cosine = F.when(norm > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), _inner(a, b) / norm))).otherwise(0.0)
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(cosine)


def successors(ids: DataFrame) -> DataFrame:
    """(doc_id, half, next_id): the next id in falling order; after the last comes the first.

    Ids are dealt by range. A range is sorted in one task and takes its last successor from the
    first id of the following range, of which there is one row each.
    """
    dealt = materialize(
        ids.repartitionByRange(F.desc("doc_id")).withColumn("part", F.spark_partition_id()), "fingerprint"
    )
    order = Window.partitionBy("part").orderBy(F.desc("doc_id"))
    parts = Window.partitionBy(F.lit(0)).orderBy("part")
    every = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    handed = (
        dealt.groupBy("part")
        .agg(F.max("doc_id").alias("first_id"))
        .withColumn("handed", F.coalesce(F.lead("first_id").over(parts), F.first("first_id").over(every)))
        .drop("first_id")
    )
    return (
        dealt.withColumn("inside", F.lead("doc_id").over(order))
        .join(handed, "part")
        .select("doc_id", "half", F.coalesce("inside", "handed").alias("next_id"))
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how alike they are.

    The edited text's last floor(n/2) code points are the first as many of the next document.
    """
    # an alias on doc_id would make the two readers of the texts look different
    key = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    own = docs.select(key, whole(F.col("text").cast("string")).alias("text"))
    n = F.length("text").cast("long")
    half = F.floor(n / 2).cast("long")
    ids = own.filter("doc_id is not null").groupBy("doc_id").agg(F.max(half).alias("half"))
    follows = materialize(successors(ids), "fingerprint").select(
        F.col("doc_id").alias("before_id"), F.col("half").alias("before_half"), F.col("next_id").alias("doc_id")
    )
    # both joins below read the same rows and columns, so that they share one shuffle of the texts;
    # fingerprints are made after it
    placed = own.filter("doc_id is not null")
    head = F.substring(F.col("text"), F.lit(1), F.col("before_half").cast("int"))
    heads = (
        with_fingerprint(placed.join(follows.hint("merge"), "doc_id"), "text", "next")
        .select(F.col("before_id").alias("doc_id"), F.struct(head.alias("head"), "next").alias("after"))
        .groupBy("doc_id")
        .agg(F.min("after").alias("after"))
    )
    followed = placed.join(heads.hint("merge"), "doc_id", "left")
    rows = followed.unionByName(own.filter("doc_id is null"), allowMissingColumns=True)
    kept = F.substring(F.col("text"), F.lit(1), (n - half).cast("int"))
    taken = F.substring(F.coalesce(F.col("after.head"), F.lit("")), F.lit(1), half.cast("int"))
    edited = with_fingerprint(rows, "text", "own").select(
        "doc_id", n.alias("n_chars"), "own", F.col("after.next").alias("next"), F.concat(kept, taken).alias("edited_text")
    )
    return with_fingerprint(edited, "edited_text", "edited").select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        written("own").alias("fingerprint"),
        written("edited").alias("edited_fingerprint"),
        likeness("own", "edited").alias("near_edited"),
        F.when(F.col("next").isNull(), 0.0).otherwise(likeness("own", "next")).alias("near_next"),
    )

"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame operations only.

1. Targets: each source gets its weight's share of all words, but never more than `most` times its
   own words; what is cut off is shared by weight among the rest (water filling, in closed form).
2. Blocks: a source's documents, ordered by a hash, form one stream of words that is cut into blocks
   of `block` words. A source's quota is the number of blocks that its target takes, in rounds.
3. Schedule: slot i of 2^k slots goes to the van der Corput point v(i) / 2^k (the bits of i
   reversed). The sources' quotas lie side by side on that axis, so a source owns exactly its quota
   of points, spread evenly over the slots. Points beyond the last quota stay idle.
4. A slot's rank among its source's slots names the block that it takes: rank r takes block
   r mod n of round r div n. The rank is a count over the bits of i and needs no sort, so a source
   that holds a third of all rows is never brought together.

Defined cases: null text has no words; a document without words is taken 0 times. A null source is a
source of its own, the last one. Documents that repeat are separate pieces of the stream. Without
documents, or with no words at all, nothing is scheduled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwind.llm.texts import WORD, whole, with_row_key
from headwind.session import materialize, settled

#: words in one block
BLOCK = 512
#: fixed value: the sources' weights in order, repeating
WEIGHTS = (5, 2, 1)
#: rows of a source that are sorted together when its stream is laid out
_TOGETHER = 1024
#: slots made by one row when the schedule is spread out
_SPREAD = 4096


def _key(df: DataFrame) -> DataFrame:
    """Null-safe key of the source."""
    return df.withColumn("src", F.coalesce(F.col("source"), F.lit(""))).withColumn("no_src", F.col("source").isNull())


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and number of words; the only pass over the texts."""
    words = F.regexp_count(whole("text"), F.lit(WORD)).cast("long")
    return _key(docs.select("doc_id", F.col("source").cast("string").alias("source"), words.alias("size")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per source: words, rows, target, and where its slots lie on the schedule's axis.

    Works on one row per source, after aggregation. With r = most * words / weight in rising order,
    a source is cut off if r is below the level that all sources from it on would share. This table is
    sorted in one task; it has one row per source, not per document.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy("no_src", "src")
    by_cap = every.orderBy("ratio", "no_src", "src")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.get(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
    quota = lambda words: (words + block - 1) / F.lit(block)
    long_ = lambda c: F.floor(c).cast("long")
    return (
        sizes.groupBy("src", "no_src")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
        .withColumn("weight", weight)
        .withColumn("ratio", most * F.col("source_size") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(every))
        .withColumn("cut", most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("all") - F.col("cut")) / F.col("open"))
        # the level rises while sources are cut off and falls afterwards; its peak is what the rest share
        .withColumn("level", F.max("level").over(every))
        .withColumn(
            "target",
            F.least(most * F.col("source_size").cast("double"), F.col("level") * F.col("weight")),
        )
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("blocks", long_(quota(F.col("source_size"))))
        .withColumn("rounds", F.when(F.col("source_size") > 0, long_(F.col("words") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("words") - F.col("rounds") * F.col("source_size"))
        .withColumn("slots", F.col("rounds") * F.col("blocks") + long_(quota(F.col("rest"))))
        .withColumn("until", F.sum("slots").over(by_name))
        .withColumn("since", F.col("until") - F.col("slots"))
        .withColumn("bits", F.length(F.bin(F.sum("slots").over(every))).cast("int"))
        .select(
            "src", "no_src", "source_size", "source_rows", "weight", "target", "words", "blocks", "rounds", "rest",
            "slots", "since", "until", "bits",
        )
    )


def _reversed_bits(value: Column, bits: Column) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(value), bits, F.lit("0"))), 2, 10).cast("long")


def _rank(i: Column, v: Column, since: Column, until: Column, bits: Column) -> Column:
    """How many j < i have their point in [since, until).

    [0, i) is a union of one run of 2^t numbers for each set bit t of i. The points of a run lie
    2^(bits - t) apart, from v mod 2^(bits - t - 1) on, so those below a bound are counted directly.
    """
    one = F.lit(1).cast("long")

    def run(total: Column, t: Column) -> Column:
        step = F.call_function("shiftleft", one, bits - t)
        first = F.call_function("pmod", v, F.call_function("shiftleft", one, bits - t - 1))
        size = F.call_function("shiftleft", one, t)
        below = lambda end: F.least(size, F.greatest(F.lit(0), F.floor((end - first + step - 1) / step).cast("long")))
        inside = F.call_function("shiftright", i, t).bitwiseAND(F.lit(1)) == 1
        return total + F.when(inside, below(until) - below(since)).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), bits - 1), F.lit(0).cast("long"), run)


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per slot: its place i, source, rank, round, block, and the words it takes of the block."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(_SPREAD).cast("long")))
    point = F.explode(F.sequence(F.col("start"), F.least(F.col("start") + _SPREAD, F.col("slots")) - 1))
    # rows here are few but each makes up to _SPREAD slots, so they must not be merged into few tasks
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole_rounds = F.col("rounds") * F.col("blocks")
    left = F.col("block") * F.lit(block)
    end = F.when(F.col("rank") < whole_rounds, F.col("source_size")).otherwise(F.col("rest"))
    return (
        plan.filter("slots > 0")
        .withColumn("start", start)
        .repartition(tasks, "src", "no_src", "start")
        .withColumn("point", point)
        .withColumn("point", F.col("since") + F.col("point"))
        .withColumn("slot", _reversed_bits(F.col("point"), F.col("bits")))
        .withColumn("rank", _rank(F.col("slot"), F.col("point"), F.col("since"), F.col("until"), F.col("bits")))
        .withColumn("round", F.floor(F.col("rank") / F.col("blocks")).cast("long"))
        .withColumn("block", F.col("rank") - F.col("round") * F.col("blocks"))
        .withColumn("slot_words", F.least(end - left, F.lit(block)).cast("long"))
        .select("slot", "src", "no_src", "rank", "round", "block", "slot_words")
    )


def laid_out(sizes: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Each document's first word in its source's shuffled stream.

    A source's hash range is cut into parts of about `_TOGETHER` rows; a part is sorted in one task
    and starts where the earlier parts end.
    """
    share = F.col("hash").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    parts = F.ceil(F.col("source_rows") / _TOGETHER)
    part = ["src", "no_src", "part"]
    order = Window.partitionBy(*part).orderBy("share", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("src", "no_src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        sizes.join(plan.select("src", "no_src", "source_size", "source_rows", "target"), ["src", "no_src"])
        .withColumn("hash", F.xxhash64("doc_id", F.lit(seed)))
        .withColumn("share", share)
        .withColumn("part", F.floor(F.col("share") * parts).cast("long"))
    )
    skip = (
        cut.groupBy(*part)
        .agg(F.sum("size").alias("skip"))
        .withColumn("skip", F.coalesce(F.sum("skip").over(earlier), F.lit(0)))
    )
    return (
        cut.withColumn("inside", F.coalesce(F.sum("size").over(order), F.lit(0)))
        .join(skip, part)
        .withColumn("first", F.col("skip") + F.col("inside"))
        .select("doc_id", "source", "src", "no_src", "size", "source_size", "target", "first")
    )


def mix(docs: DataFrame, seed: int = 11, weights: tuple[int, ...] = WEIGHTS, most: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, and the words taken of it.

    `copies` is how often the document is needed if it is never cut: taken / size, rounded up.
    """
    sizes = materialize(sized(docs), "mixing")
    plan = materialize(targets(sizes, weights, most, block), "mixing")
    stream = laid_out(sizes, plan, seed)
    key = ["doc_id", "source", "src", "no_src", "first", "size", "source_size", "target"]
    last = F.col("first") + F.col("size") - 1
    piece = F.explode(F.sequence(F.floor(F.col("first") / block), F.floor(last / block)))
    begin = F.greatest(F.col("first") - F.col("block") * block, F.lit(0))
    end = F.least(last + 1 - F.col("block") * block, F.col("slot_words"))
    has_words = stream.filter("size > 0").withColumn("block", piece)
    drawn = (
        # the schedule grows with the data, so it must not be broadcast on a guess of its size
        has_words.join(schedule(plan, block).hint("merge"), ["src", "no_src", "block"], "left")
        .groupBy(*key)
        # a block without a slot has no slot_words, and least() would pass over the null
        .agg(F.coalesce(F.sum(F.when(F.col("slot_words") > begin, end - begin)), F.lit(0)).alias("taken"))
    )
    none = stream.filter("size = 0").select(*key, F.lit(0).cast("long").alias("taken"))
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return drawn.unionByName(none).select(
        "doc_id", "source", "size", "source_size", "target", "taken", copies.alias("copies")
    )


def apply(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The documents of the mix with their own columns, each repeated `copies` times, never cut.

    A source exceeds its target by less than one document. Each row is drawn on its own, whether its
    doc_id is null, shared or its own.
    """
    rows = with_row_key(docs, "mixing")
    narrow = rows.select(F.col("__row").alias("doc_id"), "source", "text")
    drawn = settled(docs.sparkSession, lambda: mix(narrow, seed).filter("copies > 0").select("doc_id", "copies"), "mixing")
    copies = drawn.select(F.col("doc_id").alias("__row"), F.col("copies").alias("__copies"))
    each = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    # the drawn rows grow with the data, so they must not be broadcast on a guess of their size
    return rows.join(copies.hint("merge"), "__row").withColumn("__copy", each).select(*docs.columns)

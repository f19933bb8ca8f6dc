"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirespark.llm.common import carried, restored, stored, word_count

#: Hexadecimal digits of the hash that one histogram level tells apart, and of the whole hash.
LEVEL_DIGITS, HASH_DIGITS = 3, 15


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float):
    """Words wanted of each source.

    ``sizes`` has a row per source: source_order (sources by it), source_size. Weights repeat
    over the sources in that order. ``share`` times all sizes are dealt out by weight; a target
    stops at ``most`` times its source's size and the excess goes to the others by weight
    until none is above. With the sources in order of size by weight those that stop come
    first, so running sums give the common level of the rest.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy("source_order")
    everything = Window.partitionBy()
    weighted = sizes.withColumn(
        "_weight", listed[(F.row_number().over(by_name) - 1) % len(weights)]
    ).withColumn("_limit", F.col("source_size") * float(most))
    rising = Window.orderBy(F.col("_limit") / F.col("_weight"), "source_order")
    earlier = rising.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * float(share)
    level = (budget - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))) / F.sum(
        "_weight"
    ).over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # The first source that the level does not fill sets the level for itself and those after.
    leveled = weighted.withColumn("_level", level).withColumn(
        "_free", F.col("_level") * F.col("_weight") < F.col("_limit")
    )
    rank = (F.col("_limit") / F.col("_weight")).alias("_rank")
    common = F.min(F.when(F.col("_free"), F.struct(rank, "_level"))).over(everything)
    capped = F.col("_limit") / F.col("_weight") <= F.coalesce(
        common["_level"], F.lit(float("inf"))
    )
    return leveled.select(
        "source_order",
        "source_size",
        F.when(capped, F.col("_limit"))
        .otherwise(common["_level"] * F.col("_weight"))
        .alias("target"),
    )


def _boundary(rows: DataFrame, wanted: DataFrame, level: int) -> DataFrame:
    """Where each source's budget runs out among the hash buckets of a level.

    ``rows``: source_order, size, hash; ``wanted``: source_order, left (words still wanted),
    prefix (the hash so far). Sums the sizes per bucket and finds the bucket in which the
    running sum passes what is wanted: all buckets before it are taken.
    """
    digits = level * LEVEL_DIGITS
    buckets = rows.groupBy("source_order", F.substring("hash", 1, digits).alias("bucket")).agg(
        F.sum("size").alias("size")
    )
    running = Window.partitionBy("source_order").orderBy("bucket")
    before = F.sum("size").over(running) - F.col("size")
    sums = buckets.withColumn("before", before).join(wanted, "source_order")
    passed = sums.filter(F.col("before") + F.col("size") > F.col("left"))
    first = passed.groupBy("source_order").agg(
        F.min(F.struct("bucket", "before", "size", "left")).alias("b")
    )
    return first.select(
        "source_order",
        F.col("b.bucket").alias("prefix"),
        (F.col("b.left") - F.col("b.before")).alias("left"),
        F.col("b.size").alias("bucket_size"),
    )


def _source_order() -> Column:
    """A document's source; never null itself, so joins on it match null sources too."""
    return F.struct(F.col("source").isNull().alias("null"), "source")


def _hash(salt: str) -> Column:
    """Hash of a document's id, text and source: rows are taken together only if all agree."""
    parts = F.xxhash64(F.col("doc_id").cast("bigint"), "text", "source").cast("string")
    return F.substring(F.md5(F.concat(F.lit(salt), parts)), 1, HASH_DIGITS)


def _sized(docs: DataFrame, salt: str) -> DataFrame:
    """doc_id, source_order, size (words) and hash of each document, stored."""
    return stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            _source_order().alias("source_order"),
            word_count(F.col("text")).alias("size"),
            _hash(salt).alias("hash"),
        ),
        "mix-sizes",
    )


def _thresholds(
    rows: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """For each source of ``rows`` (``_sized``) its target, whole times and hash threshold."""
    sizes = rows.groupBy("source_order").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    plan = stored(
        targets.withColumn("whole", whole.cast("int")).withColumn(
            "left", F.col("target") - F.col("whole") * F.col("source_size")
        ),
        "mix-targets",
    )
    wanted, near = plan.select("source_order", "left"), rows
    for level in range(1, HASH_DIGITS // LEVEL_DIGITS + 1):
        bound = stored(_boundary(near, wanted, level), "mix-boundary")
        if level * LEVEL_DIGITS < HASH_DIGITS:
            joined = near.join(bound.select("source_order", "prefix"), "source_order")
            near = joined.filter(F.col("hash").startswith(F.col("prefix"))).drop("prefix")
            near = stored(near, "mix-bucket")
            wanted = bound.select("source_order", "left")
    ends = bound.select(
        "source_order",
        F.col("prefix").alias("threshold"),
        (F.col("left") * 2 >= F.col("bucket_size")).alias("with_threshold"),
    )
    return stored(plan.join(ends, "source_order", "left"), "mix-thresholds")


def _copies(drawn: Column, threshold: Callable[[str], Column]) -> Column:
    """How often a document of hash ``drawn`` is taken; ``threshold`` gives its source's columns."""
    # A source without a threshold gives all documents no further time (nothing is left).
    extra = (drawn < threshold("threshold")) | (
        threshold("with_threshold") & (drawn == threshold("threshold"))
    )
    return threshold("whole") + F.coalesce(extra, F.lit(False)).cast("int")


def mixed_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    salt: str = "mix",
) -> DataFrame:
    """How many words a mixture takes of each document, by source weights.

    ``docs`` needs doc_id, text and source; other columns are ignored. The size of a document
    is its number of words (null text: 0). Sources are ordered by code point, null last, and
    get targets by ``source_targets``. A source gives each of its documents as many whole
    times as fit its target; the rest of the target comes from the documents whose hash lies
    under a threshold, so a larger budget takes a superset and a rerun takes the same.

    The threshold comes from histograms, without sorting documents: words are summed by
    source and leading hash digits, the bucket in which the budget runs out is found, and only
    the documents of that bucket are summed again by further digits. The last bucket is one
    hash value; it is taken if that comes nearer to the target. Rows that agree in doc_id, text
    and source share a hash and are taken together. An empty table gives an empty result.

    Returns doc_id, size, source_size, target, taken (words, repeats counted), copies.
    """
    rows = _sized(docs, salt)
    chosen = _thresholds(rows, weights, share, most)
    copies = _copies(F.col("hash"), F.col)
    return rows.join(chosen, "source_order").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).cast("bigint").alias("taken"),
        copies.alias("copies"),
    )


def take_copies(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    salt: str = "mix",
) -> DataFrame:
    """The documents that a mixture takes, repeated as often as ``mixed_sources`` takes them.

    Each row is judged by its own source and hash, without a join by doc_id: rows without a
    doc_id and repeated rows are taken as any other. Rows keep all columns.
    """
    chosen = _thresholds(_sized(docs, salt), weights, share, most)
    plan = chosen.select(F.struct(*chosen.columns).alias("plan"))
    rows = docs.select(_source_order().alias("order"), _hash(salt).alias("hash"), carried(docs))
    joined = rows.join(plan, F.col("order") == F.col("plan.source_order"))
    copies = _copies(F.col("hash"), lambda name: F.col(f"plan.{name}"))
    taken = joined.withColumn("copies", copies).filter("copies > 0")
    repeated = taken.select("given", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(restored(docs.columns))

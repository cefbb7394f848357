"""Splits and samples that depend only on a row's key and the seed.

Exact sizes come from a counting pass rather than from ranking a whole group in one task: keys are
spread over 65,536 hash buckets, the bucket where the wanted size is reached is found from the
counts, and only that bucket's keys are ranked. What comes of it is a limit per group, by which rows
are then filtered as they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from msgrisk.constants import EXAMPLES_PER_CLUSTER, SEED, TEST_SHARE
from msgrisk.functions.hashing import digest_number, keyed_digest, unit_hash
from msgrisk.session import materialised

BUCKET_DIGITS = 4


def hash_split(df: DataFrame, key: str = "msg_id", share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Append fold ('test' / 'train') from the key's hash: no shuffle, stable across runs."""
    fold = F.when(unit_hash(F.col(key), seed) < share, "test").otherwise("train")
    return df.withColumn("fold", fold)


def _limits(df: DataFrame, wanted: DataFrame, group: str, key: str, seed: int) -> DataFrame:
    """(group, _at, _last, _spare, _tied): the last chosen (digest, key) of each group that has more rows than wanted.

    _last is null where none is wanted. _spare rows that equal _last are chosen; _tied says that there are more.
    Reads keys alone, twice: for the counts of the buckets and for the ranks in one bucket a group.
    """
    hashed = df.select(group, keyed_digest(F.col(key), seed).alias("_digest"), F.col(key).alias("_key")).withColumn(
        "_bucket", digest_number(F.col("_digest"), BUCKET_DIGITS).cast("int")
    )
    counts = hashed.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    # At most 65,536 rows per group reach this window.
    upto = Window.partitionBy(group).orderBy("_bucket")
    cut = (
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .join(F.broadcast(wanted), group)
        .filter(F.col("_upto") >= F.col("wanted"))
        .groupBy(group)
        .agg(F.min(F.struct("_bucket", (F.col("wanted") - F.col("_upto") + F.col("_n")).alias("need"))).alias("_cut"))
        .select(group, F.col("_cut._bucket").alias("_at"), F.col("_cut.need").alias("_need"))
    )
    cut = materialised(cut, "sample-cuts")
    order = Window.partitionBy(group).orderBy("_digest", "_key")
    here = F.struct("_digest", "_key")
    last = (
        hashed.join(F.broadcast(cut), group).filter("_bucket = _at")
        .select(group, here.alias("_last"), "_need", F.row_number().over(order).alias("_place"), F.rank().over(order).alias("_first"),
                F.lead(here).over(order).alias("_next"))
        .filter("_place = _need")
        .select(group, "_last", (F.col("_need") - F.col("_first") + 1).alias("_spare"), F.col("_next").eqNullSafe(F.col("_last")).alias("_tied"))
    )
    return materialised(cut.select(group, "_at").join(last, group, "left"), "sample-limits")


def mark_lowest(
    df: DataFrame, wanted: DataFrame, group: str, key: str, flag: str = "chosen", seed: int = SEED
) -> DataFrame:
    """Append a boolean: is the row among its group's `wanted` rows of lowest hash?

    wanted is (group, wanted) with one row per group and must be small: it has one row per class. Rows are compared
    with their group's limit as they are read, so whole rows are read once and not shuffled. Only where keys repeat
    right at a limit, those rows are counted off.
    """
    limits = _limits(df, wanted, group, key, seed)
    placed = df.withColumn("_here", F.struct(keyed_digest(F.col(key), seed).alias("_digest"), F.col(key).alias("_key"))).join(
        F.broadcast(limits), group, "left"
    )
    # A group without a limit has no more rows than wanted.
    below = F.col("_at").isNull() | F.coalesce(F.col("_here") <= F.col("_last"), F.lit(False))
    kept = [*df.columns, flag]
    if not limits.filter("_tied").limit(1).collect():
        return placed.withColumn(flag, below).select(*kept)
    level = F.coalesce(F.col("_here") == F.col("_last"), F.lit(False))
    counted = F.row_number().over(Window.partitionBy(group).orderBy("_here")) <= F.col("_spare")
    apart = placed.filter(~level).withColumn(flag, below)
    return apart.unionByName(placed.filter(level).withColumn(flag, counted)).select(*kept)


def class_test_sizes(counts: DataFrame, label: str, share: float = TEST_SHARE) -> DataFrame:
    """(label, wanted): test rows per class of a stratified split.

    counts is (label, n). The test set has ceil(share * n) rows; training rows go to classes in
    proportion, those left over by largest remainder.
    """
    everything = Window.partitionBy(F.lit(0))
    shares = (
        counts.withColumn("_total", F.sum("n").over(everything))
        .withColumn("_train", F.col("_total") - F.ceil(F.lit(share) * F.col("_total")))
        .withColumn("_exact", F.col("n") * F.col("_train") / F.col("_total"))
        .withColumn("_base", F.floor("_exact"))
        .withColumn("_spare", F.col("_train") - F.sum("_base").over(everything))
    )
    by_remainder = Window.partitionBy(F.lit(0)).orderBy(
        F.desc(F.round(F.col("_exact") - F.col("_base"), 9)), label
    )
    extra = (F.row_number().over(by_remainder) <= F.col("_spare")).cast("bigint")
    return shares.select(label, (F.col("n") - F.col("_base") - extra).alias("wanted"))


def stratified_split(
    df: DataFrame, label: str = "y", key: str = "msg_id", share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Append fold with exact per-class test sizes."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    marked = mark_lowest(df, class_test_sizes(counts, label, share), label, key, "_test", seed)
    return marked.withColumn("fold", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def capped_sample(df: DataFrame, size: int, key: str = "msg_id", seed: int = SEED) -> DataFrame:
    """All rows where there are at most `size`, else the `size` rows of lowest hash."""
    spark = df.sparkSession
    wanted = spark.range(1).select(F.lit(0).alias("_all"), F.lit(size).cast("bigint").alias("wanted"))
    marked = mark_lowest(df.withColumn("_all", F.lit(0)), wanted, "_all", key, "_in", seed)
    return marked.filter("_in").drop("_in", "_all")


def cluster_examples(
    df: DataFrame,
    cluster: str = "cluster_id",
    key: str = "msg_id",
    size: int = EXAMPLES_PER_CLUSTER,
    seed: int = SEED,
) -> DataFrame:
    """Up to `size` rows per cluster as (cluster, key, example_rank).

    The rank limit also applies before the shuffle, so a cluster holding a third of the rows sends
    `size` rows per task. Only ids are sorted; join the texts back for the few chosen rows.
    """
    order = Window.partitionBy(cluster).orderBy("_digest", key)
    return (
        df.select(cluster, key, keyed_digest(F.col(key), seed).alias("_digest"))
        .withColumn("example_rank", F.row_number().over(order))
        .filter(F.col("example_rank") <= size)
        .drop("_digest")
    )

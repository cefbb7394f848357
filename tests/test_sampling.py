import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from msgrisk.operators import sampling


def brute(rows, wanted, seed=42):
    """Chosen (group, key) pairs with their number."""
    out = Counter()
    for g in {g for g, _ in rows}:
        mine = sorted((k for h, k in rows if h == g), key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
        out.update((g, k) for k in mine[:wanted.get(g, len(mine))])
    return out


# Class 1 holds most rows; one key of class 2 makes up half of it; class 3 is wanted whole, class 4 not at all.
ROWS = [(1, k) for k in range(3000)] + [(2, 7)] * 50 + [(2, k) for k in range(10_000, 10_050)] + [(3, k) for k in range(5)] + [(4, k) for k in range(5)]


@pytest.mark.parametrize("wanted", [{1: 1, 2: 10, 3: 5, 4: 0}, {1: 1234, 2: 60, 3: 9, 4: 0}, {1: 2999, 2: 99, 3: 4, 4: 1}])
def test_lowest_rows_against_brute_force(spark, wanted):
    df = spark.createDataFrame([(g, k, "text") for g, k in ROWS], "y int, msg_id bigint, text string").repartition(7)
    sizes = spark.createDataFrame(list(wanted.items()), "y int, wanted bigint")
    marked = sampling.mark_lowest(df, sizes, "y", "msg_id")
    assert marked.columns == ["y", "msg_id", "text", "chosen"] and marked.count() == len(ROWS)
    got = Counter((r.y, r.msg_id) for r in marked.filter("chosen").collect())
    assert got == brute(ROWS, wanted)


def test_rows_are_filtered_where_they_are_read(spark, tmp_path):
    spark.range(5000).select((F.col("id") % 3).cast("int").alias("y"), F.col("id").alias("msg_id"), F.lit("text").alias("text")).write.parquet(str(tmp_path / "t"))
    split = sampling.stratified_split(spark.read.parquet(str(tmp_path / "t")))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count(f"InMemoryFileIndex(1 paths)[file:{tmp_path}") == 1
    assert split.filter("fold = 'test'").count() == 1000


def test_samples_of_little(spark):
    df = spark.createDataFrame([(1, None), (1, 5)], "y int, msg_id bigint")
    assert sampling.capped_sample(df, 1).count() == 1 and sampling.capped_sample(df, 5).count() == 2
    assert sampling.capped_sample(df.limit(0), 5).count() == 0 and sampling.stratified_split(df.limit(0)).count() == 0

"""Running sums and numbers over wide rows: every row once, each place once."""

import pytest
from pyspark.sql import functions as F

from talkweave.operators import shards, vectors


@pytest.fixture(scope="module")
def wide(spark):
    """1.2 million rows; a third have the same order key, and one column is wide enough for several partitions."""
    key = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_000)))
    return spark.range(1_200_000).select("id", key.alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("wide"), (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_numbered_keeps_wide_rows(spark, wide, adaptive):
    was = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = shards.numbered(wide, "k", "n")
        row = got.agg(F.count("*").alias("rows"), F.countDistinct("n").alias("places"), F.min("n").alias("low"), F.max("n").alias("high"), F.countDistinct("id").alias("ids"), F.countDistinct("wide").alias("w")).first()
        assert tuple(row) == (1_200_000, 1_200_000, 1, 1_200_000, 1_200_000, 1_200_000)
        before = got.groupBy("k").agg(F.min("n").alias("a"), F.max("n").alias("b")).orderBy("k").collect()
        assert all(x.b < y.a for x, y in zip(before, before[1:]))
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)


def test_running_sum_by_brute_force(spark):
    rows = [(i * 37 % 101, None if i % 11 == 0 else (i % 13) - 6, f"x{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, v int, name string")
    got = shards.running_sum(df, ["k", "name"], "v", "total").collect()
    total, want = 0, {}
    for k, v, name in sorted(rows, key=lambda r: (r[0], r[2])):
        total += v or 0
        want[k, name] = total
    assert {(r.k, r.name): r.total for r in got} == want and len(got) == len(rows)
    doubles = shards.running_sum(df.withColumn("v", F.col("v") / 4), ["k", "name"], "v", "total").collect()
    assert {(r.k, r.name): r.total for r in doubles} == {k: v / 4 for k, v in want.items()}
    assert shards.running_sum(df.limit(0), ["k"], "v", "total").count() == 0
    clash = df.withColumns({"_part": F.lit(1), "_run": F.lit(2), "_tie": F.lit(3)})
    assert shards.numbered(clash, "k", "n").columns == [*clash.columns, "n"]


def test_batches_and_shares_of_wide_rows(spark, wide):
    some = wide.limit(50_000)
    sizes = {r.batch: r["count"] for r in vectors.batches(some, "id", 1000).groupBy("batch").count().collect()}
    assert sizes == {i: 1000 for i in range(50)}
    parts = [vectors.share(some, 3, k, "id") for k in range(3)]
    assert sum(p.count() for p in parts) == 50_000 and parts[0].columns == wide.columns

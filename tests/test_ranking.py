import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registra.operators import ranking


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 10, 1003])
def test_ntile_equals_the_window_function(spark, n):
    # A third of the rows share one value.
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 101).alias("v"))
    mine = ranking.global_ntile(df, 4, {"v": F.col("v"), "id": F.col("id")}, "bucket")
    theirs = df.withColumn("bucket", F.ntile(4).over(W.orderBy("v", "id")))
    assert sorted(mine.collect()) == sorted(theirs.collect())


@pytest.mark.parametrize("values", [[5] * 40, [-(1 << 63), (1 << 63) - 1, 0, -1, 1] * 3, [i * 10**15 for i in range(-9, 9)], [0, 0, 0, 1 << 40]])
def test_ntile_of_ties_and_of_any_number(spark, values):
    df = spark.createDataFrame([(v, i * 70_000, -i) for i, v in enumerate(values)], "v bigint, a bigint, b bigint")
    for order in (["v", "a"], ["v", "b"], ["b"]):
        mine = ranking.global_ntile(df, 4, {c: F.col(c) for c in order}, "bucket")
        theirs = df.withColumn("bucket", F.ntile(4).over(W.orderBy(*order)))
        assert sorted(mine.collect()) == sorted(theirs.collect())
    assert ranking.rows_at(df, {"b": F.col("b")}, [0, len(values) - 1, len(values)]) == [(1 - len(values),), (0,)]


def test_ntile_neither_sorts_nor_moves_rows(spark):
    df = spark.range(1000).withColumn("v", F.lit(7))
    text = ranking.global_ntile(df, 4, {"v": F.col("v"), "id": F.col("id")}, "bucket")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text and "Join" not in text


def test_global_rank_is_dense_for_any_partitioning(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    for parts in (1, 7, 40):
        got = ranking.global_rank(df.repartition(parts), [F.desc("k")]).collect()
        assert all(r.rank == 4999 - r.k and r.total_rows == 5000 for r in got)


def test_running_offset(spark):
    df = spark.range(1, 3001).select("id", (F.col("id") % 5).alias("n")).repartition(9)
    expected = df.withColumn("o", F.sum("n").over(W.orderBy("id")) - F.col("n"))
    for block in (2, 50, 1024):
        got = ranking.running_offset(df, "id", F.col("n"), "o", block=block)
        assert sorted(got.collect()) == sorted(expected.collect())


def test_first_per_key_null_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (2, 3, "b"), (2, 3, "a"), (3, 1, None), (3, 1, "z")], "k int, w int, s string")
    order = [*ranking.descending_nulls_first(F.col("w")), *ranking.ascending_nulls_last(F.col("s"))]
    got = ranking.first_per_key(df, ["k"], order, ["w", "s"])
    assert sorted(map(tuple, got.collect())) == [(1, None, "b"), (2, 3, "a"), (3, 1, "z")]


def test_first_n_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    top = ranking.first_n_per_key(df, ["k"], [F.asc("id")], 3)
    assert sorted(r.id for r in top.collect()) == [0, 1, 2, 3, 4, 5]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")

"""Sized broadcasts, salted joins and the emptying of stored tables."""
from collections import Counter

from riskgraph.llm import common as C


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_follows_the_measured_bytes(spark):
    wide = C.stored(spark.createDataFrame([(1, "x" * 1000, ["é" * 50] * 10)], "k long, t string, a array<string>"), "wide")
    df = spark.range(10).withColumnRenamed("id", "k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(df.join(C.measured_side(wide, 3000), "k"))
        assert "BroadcastHashJoin" not in plan(df.join(C.measured_side(wide, 2000), "k"))
        assert "BroadcastHashJoin" in plan(df.join(C.measured_side(C.stored(wide.limit(0), "none"), 1), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_salted_join_gives_the_rows_of_the_plain_one(spark, monkeypatch):
    left = spark.createDataFrame([("hot" if k % 3 else f"k{k}", k) for k in range(300)] + [(None, -1)], "key string, v long")
    right = C.stored(spark.createDataFrame([("hot", 1), ("k0", 2), ("k9", 3), (None, 4)], "key string, w long"), "right")
    for how in ("inner", "left"):
        want = Counter(map(tuple, left.join(right, "key", how).collect()))
        assert Counter(map(tuple, C.salted_join(left, right, "key", "v", how).collect())) == want
        monkeypatch.setattr(C, "measured_side", lambda df: df)
        assert Counter(map(tuple, C.salted_join(left, right, "key", "v", how).collect())) == want
        monkeypatch.undo()


def test_cleanup_empties_what_is_left(spark):
    C.cleanup(spark)
    a, b = (C.stored(spark.range(5), n) for n in "ab")
    C.discard(a)
    assert b.count() == 5
    assert C.cleanup(spark) == 1 and C.cleanup(spark) == 0
    assert spark.read.parquet(b.stored_path).count() == 0

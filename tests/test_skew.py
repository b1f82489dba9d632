"""Hot keys: a hub number with a third of all calls, a hot pair, a hot mobile in
the score join.  Results must be whole and equal to a brute-force count."""
from collections import Counter

from pyspark.sql import functions as F

from riskgraph.functions.exprs import CHANNEL_OUT
from riskgraph.operators import edges, neighbours, repayment

HUB = "13900000000"


def _calls(spark, n=6000):
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((HUB, f"138{i % 500:08d}", CHANNEL_OUT, "10", "d"))   # hub: a third of all rows
        elif i % 3 == 1:
            rows.append(("13700000001", "13700000002", CHANNEL_OUT, str(i % 7), "d"))  # one hot pair
        else:
            rows.append((f"136{i:08d}", f"135{i:08d}", CHANNEL_OUT, "5", "d"))
    return rows


def test_hub_and_hot_pair_edges_are_whole(spark):
    data = _calls(spark)
    df = spark.createDataFrame(data, "mobile string, other_mobile string, call_channel string, "
                                     "call_time string, dt string").repartition(16)
    e = edges.call_edges(df, None, min_n=1)
    got = {(r["src"], r["dst"]): r["calls"] for r in e.collect()}
    assert got == dict(Counter((m, o) for m, o, *_ in data))
    hub = neighbours.one_degree(edges.edge_pairs(e), distinct_pairs=True)
    hub_rows = hub.filter(F.col("mobile") == HUB).collect()
    assert len(hub_rows) == 1
    assert hub_rows[0]["neighbours"] == sorted({o for m, o, *_ in data if m == HUB})


def test_skewed_score_join_split_by_aqe(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.createDataFrame(
            [(i, "w", HUB if i % 3 == 0 else f"137{i:08d}", 0, i % 30) for i in range(3000)],
            "loan_id bigint, ds string, mobile string, early_day int, overdue_day int")
        scores = spark.createDataFrame([(HUB, float(s)) for s in range(3)] + [(f"137{i:08d}", 1.0) for i in range(3000)],
                                       "mobile string, score double")
        out = repayment.score_vs_overdue(facts, scores)
        assert out.count() == 1000 * 3 + 2000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

import pytest
from pyspark.sql import functions as F

from riskgraph.functions import exprs as X
from riskgraph.operators import edges, neighbours
from tests.conftest import rows

OUT, IN = X.CHANNEL_OUT, X.CHANNEL_IN
A, B_, C, D = "13800000001", "13800000002", "13800000003", "13800000004"
SCHEMA = "mobile string, other_mobile string, call_channel string, call_time string, dt string"


def calls(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def members(spark, *ms):
    return spark.createDataFrame([(m,) for m in ms], "mobile string")


def test_edge_stats_traps(spark):
    data = [
        (A, B_, OUT, "60", "2001-08-01"),
        (B_, A, IN, "12a", "2001-08-02"),      # incoming: A called B; bad duration counts as 0
        (A, B_, OUT, "", "2001-08-03"),
        (A, B_, OUT, None, "2001-08-03"),
        (A, B_, OUT, "12\n", "2001-08-03"),
        (A, A, OUT, "30", "2001-08-03"),       # self-call
        (A, A, OUT, "31", "2001-08-03"),
        (A, C, OUT, "10", "2001-08-03"),       # single call: dropped by n > 1
        ("1380000000", B_, OUT, "10", "2001-08-03"),   # 10 digits
        ("1380000000", B_, OUT, "10", "2001-08-03"),
        ("03800000000", B_, OUT, "10", "2001-08-03"),  # 0 first
        ("03800000000", B_, OUT, "10", "2001-08-03"),
        (None, B_, OUT, "10", "2001-08-03"),
        (None, B_, OUT, "10", "2001-08-03"),
    ]
    e = edges.with_mean_text(edges.call_edges(calls(spark, data), None))
    assert rows(e, "src", "dst", "calls", "mean_text") == [(A, A, 2, "30.50"), (A, B_, 5, "12.00")]


def test_membership_both_ends_and_owner(spark):
    data = [(A, B_, OUT, "1", "d")] * 2 + [(A, C, OUT, "1", "d")] * 2 + [(C, A, IN, "1", "d")] * 2
    m = members(spark, A, B_)
    both = edges.call_edges(calls(spark, data), m)
    assert rows(both, "src", "dst", "calls") == [(A, B_, 2)]
    owner = edges.call_edges(calls(spark, data), m, ends="owner")
    assert rows(owner, "src", "dst", "calls") == [(A, B_, 2), (A, C, 2)]
    # the owner test is on the record owner before orientation: C owns (C, A, IN)
    owner_c = edges.call_edges(calls(spark, data), members(spark, C), ends="owner")
    assert rows(owner_c, "src", "dst", "calls") == [(A, C, 2)]


@pytest.mark.parametrize("mode", ["auto", False])
def test_broadcast_modes_agree(spark, mode):
    data = [(A, B_, OUT, "1", "d")] * 3 + [(B_, C, OUT, "1", "d")] * 3
    m = members(spark, A, B_, C)
    assert rows(edges.call_edges(calls(spark, data), m, broadcast=mode), "src", "dst") == [(A, B_), (B_, C)]


def test_unknown_channel(spark):
    data = [(A, B_, OUT, "1", "d"), (A, B_, OUT, "1", "d"), (A, B_, "999", "1", "d"), (A, B_, None, "1", "d")]
    with pytest.raises(Exception, match="unknown call_channel"):
        edges.call_edges(calls(spark, data), None).collect()
    kept = edges.call_edges(calls(spark, data), None, on_unknown="drop")
    assert rows(kept, "src", "dst", "calls") == [(A, B_, 2)]
    with pytest.raises(Exception, match="unknown call_channel"):
        edges.rank_edges(calls(spark, data), members(spark, C, D)).collect()


def test_channel_is_checked_before_the_number_pattern(spark):
    short = [("13", "14", "999", "1", "d")]
    with pytest.raises(Exception, match="unknown call_channel"):
        edges.call_edges(calls(spark, short), None, pattern=X.LOOSE, prefix=X.PREFIX).collect()
    for mode in ("auto", False):
        with pytest.raises(Exception, match="unknown call_channel"):
            edges.call_edges(calls(spark, short), members(spark, "13", "14"), broadcast=mode).collect()
    with pytest.raises(Exception, match="unknown call_channel"):  # also when no column of it is read
        edges.orient_calls(calls(spark, short)).count()


@pytest.mark.parametrize("mode", ["auto", False])
def test_where_the_channel_is_checked(spark, mode):
    data = [(A, B_, OUT, "1", "d")] * 2 + [(C, D, "999", "1", "d")]
    m = members(spark, A, B_)
    # joined first: a bad record of others is never looked at
    assert rows(edges.call_edges(calls(spark, data), m, broadcast=mode), "src", "dst") == [(A, B_)]
    with pytest.raises(Exception, match="unknown call_channel"):
        edges.call_edges(calls(spark, data), m, check="history", broadcast=mode).collect()
    with pytest.raises(Exception, match="unknown call_channel"):
        edges.rank_edges(calls(spark, data), m, broadcast=mode).count()


def test_cohort_is_read_anew_by_every_query(spark, outdir):
    data = [(A, B_, OUT, "1", "d")] * 2 + [(A, C, OUT, "1", "d")] * 2
    members(spark, A, B_).write.parquet(f"{outdir}/cohort")

    def run():
        cohort = spark.read.schema("mobile string").parquet(f"{outdir}/cohort")
        return rows(edges.call_edges(calls(spark, data), cohort), "src", "dst")
    assert run() == [(A, B_)]
    members(spark, C).write.mode("append").parquet(f"{outdir}/cohort")
    assert run() == [(A, B_), (A, C)]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_loose_and_any11_patterns(spark):
    data = [("138000", "1380000", OUT, "5", "d")] * 2 + [("13800", "138000", OUT, "5", "d")] * 2
    loose = edges.call_edges(calls(spark, data), None, pattern=X.LOOSE, prefix=X.PREFIX)
    assert rows(loose, "src", "dst") == [("p138000", "p1380000")]
    data = [("03800000000", "23800000000", OUT, "5", "d")] * 2
    m = members(spark, "03800000000", "23800000000")
    assert rows(edges.call_edges(calls(spark, data), m, pattern=X.ANY11), "src", "dst") == \
        [("03800000000", "23800000000")]
    assert edges.call_edges(calls(spark, data), m).count() == 0


def test_rank_edges_distinct_pairs_and_persons(spark):
    data = [(A, B_, OUT, "1", "d"), (A, B_, OUT, "2", "d"), (A, C, IN, "1", "d"), (A, A, OUT, "1", "d")]
    m = members(spark, A, B_, C)
    pairs = edges.rank_edges(calls(spark, data), m)
    assert rows(pairs) == [(A, A), (A, B_), (C, A)]
    e = edges.call_edges(calls(spark, data), m)
    assert rows(edges.persons(e)) == [(A,), (B_,)]  # only the pair with two calls survives


def test_shuffled_input_gives_same_edges(spark):
    import random
    base = [(A, B_, OUT, str(i), "d") for i in range(5)] + [(B_, C, IN, str(i), "d") for i in range(4)]
    rnd = random.Random(7)
    shuffled = base[:]
    rnd.shuffle(shuffled)
    e1 = edges.call_edges(calls(spark, base).repartition(3), None)
    e2 = edges.call_edges(calls(spark, shuffled).repartition(5), None)
    assert rows(e1) == rows(e2)


def test_neighbours_directed_undirected_and_split(spark):
    e = spark.createDataFrame([(A, B_), (A, C), (C, A), (A, A)], "src string, dst string")
    directed = rows(neighbours.one_degree(e).select("mobile", F.concat_ws("\t", "neighbours")))
    assert directed == [(A, f"{A}\t{B_}\t{C}"), (C, A)]
    und = neighbours.all_neighbours(e)
    pairs = set(rows(und))
    assert all((b, a) in pairs for a, b in pairs)  # symmetric
    und_lines = rows(neighbours.one_degree(e, directed=False).select("mobile", F.concat_ws("\t", "neighbours")))
    assert und_lines == [(A, f"{A}\t{B_}\t{C}"), (B_, A), (C, A)]
    # a hub is one line, whatever its degree
    hub = spark.createDataFrame([(A, f"139{i:08d}") for i in range(500)], "src string, dst string").repartition(7)
    lines = neighbours.one_degree(hub).collect()
    assert len(lines) == 1 and lines[0]["neighbours"] == [f"139{i:08d}" for i in range(500)]


@pytest.mark.parametrize("mode", ["auto", False])
def test_records_path_broadcast_modes_agree(spark, mode):
    from riskgraph.operators import history_totals as H
    data = [(A, B_, OUT, "10", "d1")] * 2 + [(B_, A, IN, "4", "d2")] + [(B_, C, OUT, "1", "d2")] * 3 + \
        [(C, D, OUT, "1", "d1")] * 2
    totals = H.day_totals(calls(spark, data))
    m = members(spark, A, B_, C)
    e = H.call_edges_from_totals(totals, m, broadcast=mode)
    assert rows(e, "src", "dst", "calls") == [(A, B_, 3), (B_, C, 3)]
    assert rows(H.rank_edges_from_totals(totals, m, broadcast=mode)) == [(A, B_), (B_, C)]
    owner = H.call_edges_from_totals(totals, members(spark, C), ends="owner", broadcast=mode, min_n=1)
    assert rows(owner, "src", "dst", "calls") == [(C, D, 2)]

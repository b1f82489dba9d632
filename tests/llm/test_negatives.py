"""Hard negatives against all pairs on small rows."""
import math
import random

import numpy as np
import pyarrow as pa

from riskgraph.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, uid int, bucket string, part string"


def usable(e):
    return e is not None and all(x is not None and math.isfinite(x) for x in e)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))  # the shorter one goes on with zeros


def brute(rows):
    kept = []
    for uid, (i, e, label) in enumerate(rows):
        if label is not None and usable(e):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            kept.append((uid, i, label, [math.floor(256 * float(np.float32(x))) for x in e]))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for uid, i, label, v in kept:
        if i is None or i % 100:
            continue
        scored = [(dot(v, w), j, other == label) for u, j, other, w in kept if u != uid]
        for ps, p, _ in sorted((s for s in scored if s[2]), key=order)[:5]:
            fit = sorted((s for s in scored if not s[2] and 80 * ps <= 100 * s[0] <= 100 * ps), key=order)[:5]
            out += [(i, p, k + 1, j, ps, s) for k, (s, j, _) in enumerate(fit)]
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in N.hard_negatives(df).collect()), key=str) == brute(rows)


def cloud(n, dims, seed, scale=lambda r: 1.0):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for k in range(n):
        c = rnd.choice(centres)
        f = scale(rnd)
        rows.append((k * 10, [f * (x + rnd.gauss(0, 0.4)) for x in c], rnd.randint(0, 3)))
    return rows


def test_unit_and_mixed_lengths(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 40)
    monkeypatch.setattr(N, "ANCHORS_AT_ONCE", 7)
    check(spark, cloud(500, 8, 1))
    check(spark, cloud(500, 5, 2, scale=lambda r: math.exp(r.gauss(0, 2))))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(60, 3, 3)
    rows += [(100, [1.0, 2.0, 3.0], 1)] * 3 + [(7, [1.0, 2.0, 3.0], 9), (None, [1.0, 2.0, 3.0], 2), (None, [1.0, 2.0, 3.0], 2)]
    rows += [(300, None, 1), (300, [1.0, None], 1), (300, [nan, 1.0], 1), (300, [inf, 1.0], 1), (300, [1.0, 1.0], None)]
    rows += [(400, [], 1), (401, [], 1), (402, [], 2), (500, [0.0, 0.0, 0.0], 1), (600, [1.0, 2.0], 1), (601, [1.0, 2.0, 5.0, 7.0], 1)]
    rows += [(800, [-1.0, -1.0, -1.0], 5), (801, [1.0, 1.0, 1.0], 5), (900, [9e4, 8e4, 1e5], 1), (901, [9e4, 8e4, 1e5], 1), (902, [9e4, 7e4, 1e5], 2)]
    check(spark, rows)


def test_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    rows = [(k, [1.0, 0.5], k % 3) for k in range(300)] + [(k, [0.9, 0.5], k % 3) for k in range(300, 420)]
    check(spark, rows)


def test_passes(spark, monkeypatch):
    monkeypatch.setattr(N, "PASS_ANCHORS", 3)
    check(spark, cloud(200, 4, 5))


def test_empty(spark):
    assert N.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    assert N.hard_negatives(spark.createDataFrame([(1, [1.0], 1, 1, "x", "y")], SCHEMA)).collect() == []


def test_ranges_lose_no_row_and_prune():
    rows = [(i, [x / math.dist(e, [0] * 3) for x in e], label) for i, e, label in cloud(400, 3, 7)]
    v = [[math.floor(256 * x) for x in e] for _, e, _ in rows]
    norm = [math.sqrt(dot(x, x)) for x in v]
    t = pa.table({"uid": list(range(400)), "vec_id": [r[0] for r in rows], "label": [r[2] for r in rows], "v": v,
                  "norm": norm, "bucket": pa.array([0] * 400, pa.int32())})
    block = next(N._read_blocks([N._block(t).combine_chunks().to_batches()[0]]))
    anchors = N.Anchors(t.slice(0, 30))
    scores = N._scores(block, anchors, np.arange(30), np.arange(400))
    assert scores.tolist() == [[dot(a, b) for b in v] for a in v[:30]]
    floors = np.sort(scores, axis=1)[:, -5].astype(float)
    mask = N.feasible(block, anchors, np.arange(30), floors)
    assert mask[scores >= floors[:, None]].all()
    assert mask.mean() < 0.9

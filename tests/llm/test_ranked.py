"""Ranked search against a brute-force ranking on small rows."""
import math
import random
import re
from collections import Counter

import numpy as np

from riskgraph.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, top=10):
    found = [(i, Counter(split(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in found:
            n = sum(c.values())
            m = 10 + (90 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(split(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def check(spark, make, docs, items):
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as q", "'x' as queries")
    got = [tuple(r) for r in ranked.search(make(docs), asked).collect()]
    assert sorted(got, key=str) == brute(docs, items)


def test_random_rows(spark, make):
    rnd = random.Random(1)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ωμέγα", "ὈΔΌΣ", "naïve"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(k, " ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 80)))) for k in range(400)]
    docs += [(k + 1000, docs[7][1]) for k in range(40)] + [(None, docs[3][1]), (None, "w1 w2 w59"), (5, docs[8][1]), (5, docs[8][1])]
    items = [(k, " ".join(rnd.choices(vocabulary, k=6))) for k in range(15)]
    check(spark, make, docs, items)


def test_odd_rows(spark, make):
    docs = [(1, None), (2, ""), (3, " .,; "), (4, "Alpha alpha-BETA"), (4, "Alpha alpha-BETA"), (5, "É é alpha"), (6, "a" * 5000),
            (7, "beta " * 40_000 + "gamma"), (None, "gamma alpha")]
    items = [(1, "alpha"), (2, None), (3, ""), (4, "unseen"), (5, "beta GAMMA"), (5, "beta GAMMA"), (6, "É"), (7, "a" * 5000), (None, "gamma")]
    check(spark, make, docs, items)


def test_empty_tables(spark, make):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(make([]), items).collect() == []
    assert ranked.search(make([(1, "a")]), items.limit(0)).collect() == []
    assert ranked.search(make([(1, "...")]), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_are_never_too_low():
    rnd = random.Random(2)
    docs = [(k, " ".join(rnd.choices([f"t{j}" for j in range(30)], k=rnd.randint(1, 300))).encode()) for k in range(100)]
    batch = __import__("pyarrow").RecordBatch.from_pydict({"doc_id": [d[0] for d in docs], "text": [d[1] for d in docs]})
    parts = [b.to_pylist()[0] for b in ranked._index_rows(iter([batch])) if b.column("bits")[0].as_py()]
    n_terms = sum(len(d[1].split()) for d in docs)
    query = {f"t{j}".encode(): 10 + j for j in range(0, 30, 3)}
    seen = 0
    for part in parts:
        n = np.array(part["n"])
        ub = ranked._bounds(part["bits"], n, part["slices"], ranked._pairs([query]), 1, len(docs), n_terms)[0]
        for i, bound in zip(part["doc_ids"], ub.tolist(), strict=True):
            c = Counter(docs[i][1].split())
            m = 10 + 90 * sum(c.values()) * len(docs) // n_terms
            exact = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in query.items())
            assert exact <= bound <= 2 * exact + 60_000_000
            seen += 1
    assert seen == len(docs)


def test_passes_cover_all_items(spark, make, monkeypatch):
    monkeypatch.setattr(ranked, "PASS_QUERIES", 2)
    check(spark, make, [(k, f"a{k % 5} b") for k in range(30)], [(k, f"a{k}") for k in range(5)])

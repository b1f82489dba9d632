"""Best-fit packing against a plain search, whole cover of every text, odd rows."""
import random

import numpy as np

import public_tokenizers
from tokenizers import Tokenizer

from riskgraph.llm.packing import LENGTHS, best_fit, cost, pack, packing_stage
from riskgraph.llm.tokens import END, TOKENIZER
from tests.llm.conftest import ODD


def plain(sizes, lengths):
    """Every open bin looked at for every piece."""
    cap, rest, where = [], [], []
    for k, size in enumerate(sizes):
        fits = [(r, b) for b, r in enumerate(rest) if r >= size]
        if fits:
            least = min(r for r, _ in fits)
            b = max((b for r, b in fits if r == least), key=lambda b: order.index(b))
        else:
            later = sizes[k + 1:]

            def price(c):
                return cost(c) / (size + min(c - size, sum(s for s in later if s <= c - size)))
            c = min((c for c in lengths if c >= size), key=lambda c: (price(c), c))
            b = len(cap)
            cap.append(c)
            rest.append(c)
            if k == 0:
                order = []
        rest[b] -= size
        if b in order:
            order.remove(b)
        order.append(b)
        where.append(b)
    return where, [min(c for c in lengths if c >= full - r) for full, r in zip(cap, rest)]


def test_pack_equals_the_plain_search():
    rnd = random.Random(1)
    for _ in range(60):
        lengths = (8, 16, 32)
        sizes = sorted((rnd.randint(1, 32) for _ in range(rnd.randint(1, 60))), reverse=True)
        where, caps = pack(np.array(sizes), lengths)
        assert (where.tolist(), caps) == plain(sizes, lengths)


def check(bins, want, lengths):
    got = {}
    for b in bins:
        assert b["used"] == sum(p["length"] for p in b["pieces"]) <= b["capacity"]
        assert b["capacity"] == min(c for c in lengths if c >= b["used"])
        for p in b["pieces"]:
            got.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
    assert len({b["bin_id"] for b in bins}) == len(bins)
    assert {k: sum(n for _, n in v) for k, v in got.items()} == want
    return got


def test_every_token_is_packed_once(spark):
    rnd = random.Random(2)
    rows = [(k, rnd.choice([0, 1, 5, 400, 3000, 4096, 9000])) for k in range(400)] + [(None, 7), (7000, None)]
    bins = best_fit(spark.createDataFrame(rows, "doc_id long, n long"), shard_rows=90).collect()
    got = check(bins, {k: n for k, n in rows if n}, LENGTHS)
    for k, n in rows:
        if n:
            at = 0
            for start, length in sorted(got[k]):
                assert start == at
                at += length
    assert sum(b["used"] for b in bins) / sum(b["capacity"] for b in bins) > 0.9


def test_repeated_rows_and_empty_table(spark, make):
    hot = spark.createDataFrame([(1, 10)] * 300 + [(2, 4000)], "doc_id long, n long")
    bins = best_fit(hot, shard_rows=40).collect()
    assert sum(p["length"] for b in bins for p in b["pieces"] if p["doc_id"] == 1) == 3000
    assert best_fit(hot.filter("n < 0")).collect() == []


def test_stage_packs_the_ids_of_every_text(make):
    """Ids, end ids included, fit their bins, and each text can be put together
    again from its pieces; very long texts are cut, odd ones are whole."""
    coder = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    rnd = random.Random(4)
    texts = [(k + 100, " ".join(rnd.choice(["alpha", "beta,", "naïve", "日本語", "x1"]) for _ in range(rnd.randint(1, 900)))) for k in range(60)]
    texts += [(300, "word " * 12_000), (301, "日本語のテキスト" * 4000), (None, "no id"), (None, "none either"), *ODD]
    docs = make(texts)
    bins = packing_stage(docs.sparkSession, docs, "").collect()
    got = {}
    for b in bins:
        assert len(b["ids"]) == b["used"] == sum(p["length"] for p in b["pieces"]) <= b["capacity"]
        at = 0
        for p in b["pieces"]:
            got.setdefault((p["doc_id"], p["text_hash"]), {}).setdefault(p["start"], []).append(b["ids"][at:at + p["length"]])
            at += p["length"]
    want = {}
    for i, t in texts:
        if t:
            want.setdefault((i, tuple(coder.encode(t, add_special_tokens=False).ids) + (END,)), []).append(1)
    found = {}
    for (i, _), pieces in got.items():
        copies = len(pieces[0])
        assert all(len(p) == copies and len(set(map(tuple, p))) == 1 for p in pieces.values())
        whole = [x for start in sorted(pieces) for x in pieces[start][0]]
        found[i, tuple(whole)] = [1] * copies
    assert found == want

"""Phrase and proximity matches against all windows, odd rows, the stage."""
import hashlib
import random
import re

from riskgraph.llm.decontaminate import contamination, decontamination_stage, phrase_matches
from tests.conftest import SF0001
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def model(docs, items):
    out = []
    windows = {}
    for item, t in items:
        w = words(t)
        for k in range(max(len(w) - 9, 0) or (1 if w else 0)):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                owners = windows.get(tuple(w[k:k + n]))
                if owners:
                    hit.update(range(k, k + n))
                    found |= owners
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def fixture():
    rnd = random.Random(11)
    vocab = [f"v{i}" for i in range(60)] + ["É", "é", "The", "THE", "x9"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(k, text(rnd.choice([1, 2, 9, 10, 11, 30]))) for k in range(12)] + [(3, "v1 v2"), (None, text(12)), (40, None), (41, "")]
    docs = []
    for k in range(120):
        t = text(40)
        if k % 3 == 0:
            t += ", " + items[k % len(items)][1].upper() if items[k % len(items)][1] else ""
        docs.append((k, t))
    docs += [(200, docs[3][1]), (200, docs[3][1]), *ODD, (300, "v1 " * 20000)]
    return docs, items


def test_matches_equal_all_windows(spark, make):
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(make(docs), bench).drop("n_near_items").collect()
    assert sorted(map(tuple, found), key=str) == model(docs, items)


def test_empty_tables(spark, make):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(make([]), bench).collect() == []
    none = contamination(make(ODD), bench.filter("item_id < 0")).collect()
    assert len(none) == len(ODD) and not any(r["contaminated"] for r in none)


def test_proximity_finds_a_changed_word(spark, make):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    near = "start alpha beta gamma delta extra epsilon zeta eta theta iota kappa end"
    docs = make([(1, near), (2, "alpha and nothing more of kappa"), (3, item)])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = {r["doc_id"]: r for r in contamination(docs, bench).collect()}
    assert (rows[1]["contaminated"], rows[1]["n_near_items"]) == (False, 1)
    assert (rows[2]["n_near_items"], rows[3]["contaminated"], rows[3]["n_near_items"]) == (0, True, 0)
    phrase, close, _ = phrase_matches(docs, bench)
    assert [r["start"] for r in phrase.collect()] == [0] and close.count() == 1


def near_model(docs, items):
    """Items with a run of n + 6 words that holds 80 % of a phrase's distinct words, and no phrase match."""
    out = []
    hits = {(i, x) for i, t in docs for item, it in items for x in [item] if model([(i, t)], [(item, it)])[0][2]}
    for i, t in docs:
        w, found = words(t), set()
        for item, it in items:
            v = words(it)
            for k in range(max(len(v) - 9, 0) or (1 if v else 0)):
                p = set(v[k:k + 10])
                n = len(v[k:k + 10]) + 6
                if any(100 * len(p & set(w[s:s + n])) >= 80 * len(p) for s in range(max(len(w) - n, 0) + 1)):
                    found.add(item)
        out.append((i, sum((i, item) not in hits for item in found)))
    return sorted(out)


def test_proximity_equals_all_runs(spark, make):
    rnd = random.Random(3)
    vocab = [f"v{i}" for i in range(40)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(k, text(rnd.choice([2, 5, 10, 14, 45]))) for k in range(8)]
    docs = []
    for k in range(60):
        w = items[k % 8][1].split()
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = rnd.choice([f"new{k}", rnd.choice(vocab)])
        rnd.shuffle(w) if k % 5 == 0 else None
        docs.append((k, text(rnd.randint(0, 50)) + " " + " ".join(w) + " " + text(rnd.randint(0, 30))))
    got = contamination(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_near_items"]) for r in got) == near_model(docs, items)


def test_a_replaced_word_is_found_by_proximity(spark, make):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    for place in (0, 4, 9):
        w = item.split()
        w[place] = "other"
        docs = make([(1, "before " + " ".join(w) + " after"), (2, "nothing of it")])
        rows = {r["doc_id"]: r for r in contamination(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
        assert (rows[1]["n_hit"], rows[1]["n_near_items"], rows[2]["n_near_items"]) == (0, 1, 0)


def test_case_that_depends_on_neighbours(spark, make):
    text = "ΑΣ'Α β γ δ ε ζ η θ ι"
    got = contamination(make([(1, text), (2, "ΌΔΟΣ " + text + " ΌΔΟΣ")]), spark.createDataFrame([(1, text), (2, "ΌΔΟΣ")], "item_id long, text string"))
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"]) for r in got.collect()) == [(1, 10, 10), (2, 12, 12)]


def test_stage_drops_only_contaminated_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").select("item_id", "text").collect()]
    want = {r[0] for r in model([(r["doc_id"], r["text"]) for r in docs.collect()], items) if not r[-1]}
    out = decontamination_stage(spark, docs, SF0001)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == want

"""N-gram Jaccard components against all pairs, hot groups, and odd rows."""
import random
import re

from riskgraph.llm import jaccard as J
from riskgraph.llm.components import components
from riskgraph.llm.jaccard import jaccard_components, near_duplicate_stage
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def model(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = list(range(len(sets)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k
    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                label[root(a)] = root(b)
    out = []
    for k, (i, x) in enumerate(sets):
        ids = [j for m, (j, _) in enumerate(sets) if root(m) == root(k) and j is not None] if x else [i]
        out.append((i, len(x), min(ids) if ids and ids != [None] else None))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, df.collect()), key=str)


def near_copies(seed, groups, copies, words=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    shared = [rnd.choice(vocab) for _ in range(25)]  # a passage many documents share
    rows, k = [], 0
    for _ in range(groups):
        base = [rnd.choice(vocab) for _ in range(words)]
        if rnd.random() < 0.5:
            base[10:10] = shared
        for _ in range(rnd.randint(1, copies)):
            text = base[:]
            for _ in range(rnd.randint(0, 6)):
                text[rnd.randrange(len(text))] = rnd.choice(vocab)
            rows.append((k, (" " if k % 2 else "\n").join(text)))
            k += 1
    return rows


def test_random_near_copies_match_all_pairs(make):
    rows = near_copies(1, 25, 9) + near_copies(2, 1, 60)[:60]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    rows += [(900, rows[3][1]), (901, rows[3][1].upper())] + ODD
    assert got(jaccard_components(make(rows))) == model(rows)


def test_chain_and_short_texts(make):
    base = [f"a{i}" for i in range(40)]
    chain = [(k, " ".join(base[k:k + 30])) for k in range(0, 10, 2)]  # neighbours link, ends do not
    rows = chain + [(50, "x y"), (51, "X  y"), (52, "y x")]
    assert got(jaccard_components(make(rows))) == model(rows)


def test_a_row_without_id_can_join_others(make):
    base = [f"a{i}" for i in range(40)]
    rows = [(3, " ".join(base[0:30])), (None, " ".join(base[2:32])), (9, " ".join(base[4:34]))]
    assert got(jaccard_components(make(rows))) == model(rows)


def test_empty_table(make):
    assert got(jaccard_components(make([]).filter("doc_id > 0"))) == []


def test_stage_keeps_one_of_each_group(make):
    rows = [(1000 + k, t) for k, t in near_copies(3, 8, 5)]
    rows += [(700, "only one here " * 9), (700, "only one here " * 9)] + ODD
    docs = make(rows)
    out = near_duplicate_stage(docs.sparkSession, docs, "")
    assert out.columns == docs.columns
    keep = [(i, n) for i, n, c in model(rows) if n == 0 or i is None or i == c]
    named = {i for i, n in keep if n and i is not None}  # repeated rows become one
    want = [*named, *(i for i, n in keep if not n or i is None)]
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(map(str, want))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    assert {(r["id"], r["label"]) for r in components(df).collect()} == \
        {(i, 0) for i in range(31)} | {(100 + i, 100) for i in range(20)}
    assert components(df.filter("a < 0")).count() == 0


def test_stage_decides_by_row_not_by_id(make):
    """Other texts under the id of a copy stay; copies without an id become one."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = b.rsplit(" ", 1)[0]
    rows = [(3, a), (5, a), (5, "a text of its own under a shared id"),
            (None, b), (None, b), (None, near), (None, c), (8, c), (8, c), (None, None), (None, None)]
    docs = make(rows)
    out = sorted(((r["doc_id"], r["text"]) for r in near_duplicate_stage(docs.sparkSession, docs, "").collect()), key=str)
    one = [t for i, t in out if i is None and t in (b, near)]
    assert len(one) == 1
    assert out == sorted([(3, a), (5, rows[2][1]), (None, one[0]), (8, c), (None, None), (None, None)], key=str)


def test_rows_that_share_a_notice_do_not_meet(spark, make):
    """Documents of a 100-word notice and 30 own words are no near copies."""
    rnd = random.Random(21)
    notice = " ".join(f"n{k}" for k in range(100))
    own = lambda: " ".join(f"w{rnd.randrange(10**9)}" for _ in range(30))
    rows = [(k, own() + " " + notice) for k in range(600)]
    rows += [(1000 + k, rows[k][1] + " more words here") for k in range(5)]
    found = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(make(rows)).collect()}
    assert all(found[k] == k for k in range(600)) and all(found[1000 + k] == k for k in range(5))
    # a hot column of rows whose bounds rule out equal sizes makes no pair at all
    hot = spark.range(4000).selectExpr("7L as h", "id as set_id", "126L as n", "30L as pos", "id as label")
    assert J._pairs(hot, hot, 75, "label").count() == 0


def test_pairs_meet_under_the_bounds_only(spark):
    """Band by band, the pairs of one column are those of all pairs under the bounds."""
    rnd = random.Random(22)
    rows = [(1, k, n, rnd.randrange(0, n), k) for k in range(150) for n in [rnd.randint(1, 60)]]
    df = spark.createDataFrame(rows, "h long, set_id long, n long, pos long, label long")
    want = set()
    for _, a, n, p, _ in rows:
        for _, b, m, q, _ in rows:
            if a < b and 100 * min(n, m) >= 75 * max(n, m) and 175 * min(n - p, m - q) >= 75 * (n + m):
                want.add((a, b))
    assert {(r["a"], r["b"]) for r in J._pairs(df, df, 75, "label").collect()} == want and want

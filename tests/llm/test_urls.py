"""URL rules, segmentation against all splits, naive Bayes against plain Python, odd rows."""
import itertools
import math
import random

from riskgraph.llm import urls as U


def test_segment_equals_all_splits():
    rnd = random.Random(1)
    logp = {w: -rnd.uniform(1, 9) for w in ("a", "b", "ab", "ba", "abc", "cab", "c", "bca", "aa")}
    for _ in range(60):
        name = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 8)))

        def value(parts):
            return sum(logp.get(p, -10.0 * (1 + len(p))) for p in parts)
        splits = []
        for cuts in itertools.product([0, 1], repeat=len(name) - 1):
            parts, last = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(name[last:i])
                    last = i
            splits.append([*parts, name[last:]])
        got = U.segment(name, logp, -10.0)
        assert "".join(got) == name and math.isclose(value(got), max(map(value, splits)))
    assert U.segment("", logp, -10.0) == []


def pages(spark, rows):
    return spark.createDataFrame([(k, u, h, "x", 1) for k, (u, h) in enumerate(rows)],
                                 "page_id long, url string, html string, host string, n int")


def test_rules(spark):
    cases = {"https://a.net/x": "net/", "http://EXAMPLE.net/en/1": "example.net/en/", "http://notexample.net/en/": "net/",
             "http://example.com/de/": "example.com/de/", "http://example.com/de": None, "http://x.org/fr/1?u=://b.net/": "org/fr/",
             "http://b.net": None, "http://b.net?x": None, "b.net/x": None, None: None, "": None, "http://net/": "net/",
             "http://a.net:80/": None}
    got = {r["page_id"]: r for r in U.judge(pages(spark, [(u, None) for u in cases])).collect()}
    assert [got[k]["rule"] for k in range(len(cases))] == list(cases.values())
    assert got[1]["host"] == "example.net" and got[1]["path"] == "/en/1" and got[6]["path"] == "" and got[8]["host"] == ""
    assert all(got[k]["verdict"] in ("allow", "block") for k in got)
    assert got[0]["verdict"] == "block" and got[1]["verdict"] == "allow"


def test_bayes_equals_plain_python(spark):
    html = "<html><script>var casinowin;</script><p>casino win news today paper</p></html>"
    rows = [("http://casinowin.net/play", html)] * 3 + [("http://newspaper.example.net/en/today", html)] * 4
    rows += [("http://news.casinowin.com/", html), ("http://paper.com/today/win", html), ("http://paper.com/today/win", html)]
    got = U.judge(pages(spark, rows)).orderBy("page_id").collect()
    assert got[7]["host_words"] == "news casino win com"
    b = {"h:casino": 3, "h:win": 3, "h:net": 3, "p:play": 3}
    a = {"h:news": 4, "h:paper": 4, "h:example": 4, "h:net": 4, "p:en": 4, "p:today": 4}
    v = len({*a, *b})

    def odds(tokens):
        s = math.log(3) - math.log(4)
        for t in tokens:
            if t in a or t in b:
                s += math.log((b.get(t, 0) + 1) / (sum(b.values()) + v + 1)) - math.log((a.get(t, 0) + 1) / (sum(a.values()) + v + 1))
        return s
    for k, tokens in ((7, ["h:news", "h:casino", "h:win", "h:com"]), (8, ["h:paper", "h:com", "p:today", "p:win"])):
        assert math.isclose(got[k]["score"], odds(tokens), abs_tol=1e-9)
        assert got[k]["verdict"] == ("block" if odds(tokens) > 0 else "allow")
    assert tuple(got[8])[1:] == tuple(got[9])[1:] and got[0]["score"] is None


def test_empty_table_and_long_names(spark):
    assert U.judge(pages(spark, [])).collect() == []
    rows = [("http://" + "ab" * 3000 + ".com/" + "x/" * 500, "<p>ab ab</p>")]
    assert len(U.judge(pages(spark, rows)).collect()) == 1


def test_rare_words_split_names_at_any_corpus_size(spark, monkeypatch):
    """The dictionary is whole: a word seen once splits a name among thousands
    of more frequent ones, by broadcast and by shuffle."""
    import random as r
    many = [("".join(r.Random(k).choices("klmnopqrst", k=6)), 50) for k in range(5000)]
    words = spark.createDataFrame([*many, ("zebra", 1), ("violin", 1), ("zeb", 1)], "word string, n long").dropDuplicates(["word"])
    names = spark.createDataFrame([("zebraviolin-7",), ("ZebraViolin",), ("---",), ("42",), ("uvwuvw",)], "name string")
    want = {"zebraviolin-7": ["zebra", "violin", "7"], "ZebraViolin": ["zebra", "violin"], "42": ["42"], "uvwuvw": ["uvwuvw"]}
    assert {x["name"]: x["words"] for x in U.segmented(names, words).collect()} == want
    from riskgraph.llm import common
    monkeypatch.setattr(common, "measured_side", lambda df: df)
    assert {x["name"]: x["words"] for x in U.segmented(names, words).collect()} == want


def test_a_repeated_token_counts_as_often_as_it_stands(spark):
    rows = [("http://a.net/casino", None), ("http://a.example.net/en/news", None), ("http://b.com/casino", None), ("http://b.com/casino/casino/casino", None)]
    got = {x["page_id"]: x["score"] for x in U.judge(pages(spark, rows)).collect()}
    # casino: once in the two blocked tokens' sum, not in the allowed ones
    b, a = ["h:a", "h:net", "p:casino"], ["h:a", "h:example", "h:net", "p:en", "p:news"]
    v = len({*a, *b})
    one = math.log(2 / (len(b) + v + 1)) - math.log(1 / (len(a) + v + 1))
    assert math.isclose(got[3] - got[2], 2 * one, abs_tol=1e-9)


def brute(rows):
    """The whole query in plain Python: split, rules, segmentation, Bayes."""
    import re
    count, split = {}, []
    for _, html in rows:
        seen = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ", html or "")
        for w in re.findall(r"[^\W\d_]+", seen.lower()):
            if len(w) <= U.LONGEST_WORD:
                count[w] = count.get(w, 0) + 1
    total = sum(count.values()) or 1
    logp = {w: math.log(n / total) for w, n in count.items()}
    for url, _ in rows:
        m = re.search("://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(h) + len(p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        tokens = [side + w for side, names in (("h:", host.split(".")), ("p:", path.split("/"))) for name in names
                  for run in re.findall(r"[^\W\d_]+|\d+", name.lower())
                  for w in (U.segment(run, logp, -math.log(total + 1)) if run.isalpha() else [run])]
        split.append((host, path, max(fits, default=(0, None, None))[1:], tokens))
    seen = {v: [t for _, _, (_, got), ts in split if got == v for t in ts] for v in ("block", "allow")}
    pages_of = {v: sum(got == v for _, _, (_, got), _ in split) or 1 for v in ("block", "allow")}
    known = {*seen["block"], *seen["allow"]}
    out = []
    for k, (host, path, (rule, got), tokens) in enumerate(split):
        score = math.log(pages_of["block"]) - math.log(pages_of["allow"])
        for t in tokens:
            if t in known:
                score += (math.log((seen["block"].count(t) + 1) / (len(seen["block"]) + len(known) + 1))
                          - math.log((seen["allow"].count(t) + 1) / (len(seen["allow"]) + len(known) + 1)))
        out.append((k, host, path, rule, got or ("block" if score > 0 else "allow"), None if got else round(score, 6)))
    return out


def test_whole_query_equals_plain_python(spark):
    rnd = random.Random(8)
    vocabulary = ["news", "casino", "win", "paper", "play", "day", "shop", "é", "to", "today"]
    word = lambda: rnd.choice(vocabulary)
    rows = [(None, None), ("", ""), ("nothing", "<p>day</p>"), ("http://", None), ("http://x.net/", None)]
    for _ in range(150):
        host = rnd.choice(["", "www."]) + "".join(word() for _ in range(rnd.randint(1, 3))) + rnd.choice(
            [".net", ".com", ".org", ".example.net", ".example.com"])
        path = rnd.choice(["", "/", "/en/", "/de/", "/fr/"]) + "/".join(word() + rnd.choice(["", "12", "-x"]) for _ in range(rnd.randint(0, 3)))
        rows.append((f"https://{host}/{path}".replace("//", "/").replace(":/", "://") + rnd.choice(["", "?q=casino", "#play"]),
                     "<p>" + " ".join(word() for _ in range(rnd.randint(0, 8))) + "</p>"))
    got = U.judge(pages(spark, rows)).collect()
    found = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], None if r["score"] is None else round(r["score"], 6)) for r in got)
    assert found == brute(rows)


def test_beyond_the_measured_size_no_join_broadcasts(spark, monkeypatch):
    """Spark's own estimate, the size of small files, broadcasts none of the joins."""
    from riskgraph.llm import common
    rows = [(f"http://{host}/{path}", "<p>casino win news today paper</p>")
            for host in ("casinowin.net", "newspaper.example.net", "news.casinowin.com", "paper12.com", "")
            for path in ("play/win", "en/today", "en/today/7", "")]
    key = lambda r: r["page_id"]
    want = sorted(U.judge(pages(spark, rows)).collect(), key=key)
    plans = []

    def keep(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    def written(df, name, write=U.stored):
        keep(df)
        return write(df, name)
    monkeypatch.setattr(common, "measured_side", lambda df: df)
    monkeypatch.setattr(U, "stored", written)
    got = U.judge(pages(spark, rows))
    keep(got)
    assert sum("Join" in p for p in plans) >= 7
    assert not [p for p in plans if "Broadcast" in p]
    rounded = lambda rs: [(*r[:-1], None if r["score"] is None else round(r["score"], 9)) for r in rs]
    assert rounded(sorted(got.collect(), key=key)) == rounded(want)

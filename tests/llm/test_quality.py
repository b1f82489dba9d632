"""Quality counts against plain Python, the sketch's error bound and merging, verdicts, odd rows."""
import random
import re
from collections import Counter

from riskgraph.llm import quality as Q
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    cover = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover),
            len(w) < 50 or 100 * len(cover) > 50 * len(w))


def prose(rnd, n=120):
    lines = []
    while n > 0:
        k = rnd.randint(5, 14)
        lines.append(" ".join("".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 8))) for _ in range(k)))
        n -= k
    return "\n".join(lines)


def test_counts_equal_the_model(make):
    rnd = random.Random(1)
    rows = [(k, prose(rnd, rnd.choice([3, 49, 60, 200]))) for k in range(40)]
    rows += [(50, "a b c " * 40), (51, "same line\n" * 9 + prose(rnd)), (52, "é*$ 日本 #\x0b x\n\n y"), *ODD,
             (60, "word " * 100_000)]
    found = Q.judge(make(rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((i, *counts(t)) for i, t in rows), key=str)
    assert Q.judge(make([])).collect() == []


def test_clean_stays_and_junk_goes(make):
    rnd = random.Random(2)
    rows = [(k, prose(rnd), ("en", "de", None)[k % 3], f"s{k % 2}") for k in range(700)]
    rows += [(900, prose(rnd).replace(" ", "*** ")), (901, (prose(rnd, 30) + "\n") * 4),
             (902, " ".join("x" * 40 for _ in range(60)) + " " + prose(rnd, 30)), (903, prose(rnd, 10))]
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(make(rows)).collect()}
    assert sum(kept[k] for k in range(700)) >= 693  # three quartile distances
    assert not any(kept[k] for k in (900, 901, 902, 903))


def test_sketch_is_mergeable_and_close(spark):
    rnd = random.Random(3)
    values = [int(rnd.lognormvariate(7, 2)) for _ in range(4000)]
    rows = [("en", f"s{k % 5}", v, 0, 0, 0) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "lang string, source string, word_length long, symbols long, dup_lines long, repeats long")
    parts = Q.merged(Q.sketches(df), "lang")
    whole = Q.merged(Q.sketches(df.withColumn("source", df["lang"])), "lang")
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    f = {r["feature"]: r for r in Q.fences(parts, "lang").collect()}["word_length"]
    s = sorted(values)
    q1, q3 = s[len(s) // 4 - 1], s[len(s) * 3 // 4 - 1]
    low, high = q1 - Q.REACH * (q3 - q1), q3 + Q.REACH * (q3 - q1)
    assert f["total"] == 4000
    off = (Q.GAMMA - 1) * ((1 + Q.REACH) * q3 + Q.REACH * q1) + 2 * Q.REACH + 2  # a bucket's width on each quartile
    assert abs(f["high"] - high) <= off and abs(f["low"] - low) <= off

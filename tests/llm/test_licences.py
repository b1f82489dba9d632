"""Licence scan against plain Python, size bounds, odd rows."""
import random
import re
from collections import Counter

from riskgraph.llm import licences as L
from tests.llm.conftest import ODD


def split(text):
    return re.findall(L._WORD, (text or "").lower())


def grams(w):
    return list(zip(w, w[1:]))


def anchors():
    """(bigram, template, place): of each template the fifth that is rarest, and one more."""
    held, times = {}, Counter()
    for licence, text in L.TEMPLATES:
        for g in grams(split(text)):
            held.setdefault(g, set()).add(licence)
            times[g] += 1
    out = {}
    for k, (_, text) in enumerate(L.TEMPLATES):
        g = grams(split(text))
        order = sorted(range(len(g)), key=lambda i: (len(held[g[i]]), times[g[i]], i))
        for i in order[:len(g) - -(-len(g) * L.THRESHOLD // 100) + 1]:
            out.setdefault(g[i], []).append((k, i))
    return out


def model(rows):
    out, where = [], anchors()
    for i, t in rows:
        w = split(t)
        begun = {(k, pos - off) for pos, g in enumerate(grams(w)) for k, off in where.get(g, ())}
        best = {}
        for k, start in begun:
            licence, text = L.TEMPLATES[k]
            b = Counter(grams(split(text)))
            a = Counter(grams(w[max(start, 0):start + sum(b.values()) + 1]))
            m, n, o = sum(b.values()), sum(a.values()), sum((a & b).values())
            if n and 200 * o >= L.THRESHOLD * (n + m):
                best[licence] = max(best.get(licence, (-1,)), (2 * o / (n + m), -k, -start))
        out += [(i, licence, -k, -start, round(dice, 6)) for licence, (dice, k, start) in best.items()]
    return sorted(out, key=str)


def test_matches_equal_all_templates(make):
    rnd = random.Random(4)
    rows = []
    for k in range(80):
        lines = [" ".join(rnd.choice("the of a license version public free") if rnd.random() < .3 else f"w{rnd.randrange(99)}"
                          for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 5))]
        text = rnd.choice(L.TEMPLATES)[1]
        w = text.split(" ")
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = rnd.choice(["changed", "License,", "the"])
        text = "\n".join(" ".join(w[j:j + 12]) for j in range(0, len(w), 12)) if k % 2 else " ".join(w)
        lines.insert(rnd.randrange(len(lines) + 1), rnd.choice(["", "\n"]) + text + rnd.choice(["", "\n "]))
        rows.append((k, "\n".join(lines)))
    rows += [(200, rows[0][1]), (200, rows[0][1]), (None, L.TEMPLATES[0][1].upper()), *ODD, (300, "the license " * 30000)]
    found = L.scan(make(rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == model(rows)
    assert {r["licence"] for r in found} >= {"MIT", "Apache-2.0"}


def test_clean_and_empty(make):
    assert L.scan(make([(1, "a plain sentence about nothing at all"), *ODD])).collect() == []
    assert L.scan(make([])).collect() == []


def found(make, text):
    return {r["licence"]: r["dice"] for r in L.scan(make([(1, text)])).collect()}


def test_comment_with_a_whole_licence(make):
    mit = max((t for n, t in L.TEMPLATES if n == "MIT"), key=len).split(" ")
    lines = ["Copyright (c) 2020 Someone", "", *(" ".join(mit[k:k + 11]) for k in range(0, len(mit), 11))]
    assert found(make, "/*\n" + "\n".join(" * " + x for x in lines) + "\n */\nint main() {}\n")["MIT"] == 1
    assert found(make, "\n".join("# " + x for x in lines) + "\nimport os\n")["MIT"] == 1
    assert found(make, "x " * 5000 + "// " + "\n//\n// ".join(lines) + " y" * 5000)["MIT"] == 1


def test_notice_inside_a_longer_line(make):
    assert found(make, "All texts of this site, unless stated otherwise, are Licensed under CC BY 4.0. and may be shared by you") == {"CC-BY-4.0": 1}
    assert found(make, "See the file: Released under the MIT License. Thanks to all who helped")["MIT"] == 1
    assert found(make, "This program may be redistributed by nobody") == {}


def test_a_template_is_found_with_a_fifth_of_it_changed(make):
    rnd = random.Random(6)
    for k, (licence, text) in enumerate(L.TEMPLATES):
        w = text.split(" ")
        if len(w) > 40:  # one change breaks two bigrams
            for at in rnd.sample(range(len(w)), len(w) // 12):
                w[at] = "changed"
            assert licence in found(make, "before it " + " ".join(w) + " after it"), k
            break

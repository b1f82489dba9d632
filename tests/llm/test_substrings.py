"""Substring deduplication against a plain rolling hash, planted passages, odd rows."""
import random

import numpy as np

from riskgraph.llm import substrings as S
from tests.llm.conftest import ODD


def plain_cuts(text):
    """One byte at a time."""
    h, last, out = 0, None, []
    for i, b in enumerate(text):
        h = ((h << 1) + int(S.GEAR[b])) & 0xFFFF
        at = i + 1
        if h >> (16 - S.BITS) == 0 and S.REACH <= at < len(text) and text[at] & 0xC0 != 0x80:
            if last is None or at - last > S.LEAST:
                out.append(at)
            last = at
    return out


def text_of(rnd, n):
    return " ".join("".join(rnd.choice("abcdeéßf") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def test_cuts_equal_the_plain_loop():
    rnd = random.Random(3)
    for n in (0, 1, 3, 50, 700):
        t = text_of(rnd, n).encode()
        assert S.cuts(np.frombuffer(t, np.uint8)).tolist() == plain_cuts(t)
    piece, S.PIECE = S.PIECE, 97  # in pieces, the same cuts
    try:
        t = text_of(rnd, 300).encode()
        assert S.cuts(np.frombuffer(t, np.uint8)).tolist() == plain_cuts(t)
    finally:
        S.PIECE = piece


def test_an_insertion_moves_few_chunks():
    rnd = random.Random(4)
    t = text_of(rnd, 800)
    a = {d for *_, d in S.chunks(t.encode())}
    b = {d for *_, d in S.chunks((t[:2000] + "zz" + t[2000:]).encode())}
    assert len(a - b) <= 2 and len(b - a) <= 2


def test_one_character_text_is_bounded():
    parts = S.chunks(b"a" * 100_000)
    assert max(e - s for s, e, _ in parts) <= S.MOST
    assert b"".join(b"a" * (e - s) for s, e, _ in parts) == b"a" * 100_000


def test_planted_passages_are_found_and_clean_documents_left_alone(make):
    rnd = random.Random(6)
    passages = [text_of(rnd, 55) for _ in range(40)]
    rows, holds = [], {}
    for k in range(160):
        text = text_of(rnd, 150)
        if k < 120:  # three documents share each passage
            p = passages[k % 40]
            cut = rnd.randrange(len(text))
            text = text[:cut] + " " + p + " " + text[cut:]
            holds[k] = (cut + 1, cut + 1 + len(p))
        rows.append((k, text))
    rows += ODD + [(500, rows[150][1]), (501, rows[150][1])]  # exact copies of a clean one
    found = S.repeated_spans(make(rows)).collect()
    spans = {}
    for r in found:
        spans.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
        assert r["duplicate"] == (r["first_doc_id"] < r["doc_id"])
    for k, (a, b) in holds.items():
        assert any(a - 60 <= s and e <= b + 60 for s, e in spans[k]), k
        assert sum(min(e, b) - max(s, a) for s, e in spans[k]) >= (b - a) / 3
    assert set(spans) == set(holds) | {150, 500, 501}


def test_repeats_inside_one_document_and_empty_table(make):
    rnd = random.Random(8)
    p = text_of(rnd, 80)
    assert S.repeated_spans(make([(1, p + " x " + p), (2, text_of(rnd, 90))])).collect() == []
    assert S.repeated_spans(make([])).collect() == []


def test_chance_chunks_of_different_documents_make_no_span(make):
    """A text whose chunks all occur elsewhere, each in another document."""
    rnd = random.Random(9)
    whole = text_of(rnd, 60)
    raw = whole.encode()
    rows = [(1000, whole)]
    for k, (a, b, _) in enumerate(S.chunks(raw)):  # each chunk with enough before it to be cut alike
        rows.append((k, text_of(rnd, 40) + " " + raw[max(0, a - 24):b + 4].decode(errors="ignore") + " " + text_of(rnd, 40)))
    assert S.repeated_spans(make(rows)).collect() == []


def test_spans_are_held_whole_by_the_named_document_to_exact_ends(make):
    rnd = random.Random(10)
    p, q = text_of(rnd, 60), text_of(rnd, 60)
    texts = {1: text_of(rnd, 90) + "|" + p + "|", 2: "#" + q + "#" + text_of(rnd, 90), 3: text_of(rnd, 20) + "!" + p + q + "!"}
    found = S.repeated_spans(make(list(texts.items()))).collect()
    at = texts[3].index(p)
    got = {(r["start"], r["end"], r["first_doc_id"]) for r in found if r["doc_id"] == 3}
    assert got == {(at, at + len(p), 1), (at + len(p), at + len(p) + len(q), 2)}
    assert all(r["duplicate"] == (r["doc_id"] == 3) for r in found)
    assert all(any(texts[r["doc_id"]][r["start"]:r["end"]] in t for d, t in texts.items() if d != r["doc_id"]) for r in found)


def test_rows_without_an_id_take_part(make):
    rnd = random.Random(12)
    p = text_of(rnd, 70)
    rows = [(1, text_of(rnd, 60) + " " + p), (None, p + " " + text_of(rnd, 60)), (None, text_of(rnd, 80))]
    found = S.repeated_spans(make(rows)).collect()
    assert sorted((str(r["doc_id"]), r["first_doc_id"], r["duplicate"]) for r in found) == [("1", 1, False), ("None", 1, True)]
    assert all(p[5:-5] in (rows[0] if r["doc_id"] else rows[1])[1][r["start"]:r["end"]] for r in found)


def test_whole_result_against_all_common_substrings(make):
    """Every reported span is held whole by another document and is as long as
    the two texts agree; every long common passage lies inside spans."""
    rnd = random.Random(13)
    passages = [text_of(rnd, n) for n in (60, 70, 90, 120)]
    texts = {}
    for k in range(24):
        parts = [text_of(rnd, rnd.randint(5, 40)) for _ in range(rnd.randint(1, 3))]
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            parts.insert(rnd.randrange(len(parts) + 1), p)
        texts[k] = " ".join(parts)
    texts[30] = text_of(rnd, 4000) + passages[3] + text_of(rnd, 4000)  # a very long one
    found = {}
    for r in S.repeated_spans(make(list(texts.items()))).collect():
        piece = texts[r["doc_id"]][r["start"]:r["end"]]
        holders = [d for d, t in texts.items() if piece in t]
        assert len(piece) >= S.SPAN_LEAST and len(holders) > 1 and r["first_doc_id"] in holders
        assert r["duplicate"] == (r["first_doc_id"] < r["doc_id"])
        found.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    for p in passages:
        holders = [d for d, t in texts.items() if p in t]
        for d in holders if len(holders) > 1 else []:
            a = texts[d].index(p)
            covered = {x for s, e in found.get(d, ()) for x in range(s, e)}
            assert all(x in covered for x in range(a, a + len(p))), (d, p[:20])


def test_a_very_long_text(make):
    rnd = random.Random(14)
    p = text_of(rnd, 100)
    long = text_of(rnd, 60_000) + p + text_of(rnd, 60_000)
    found = S.repeated_spans(make([(1, long), (2, "x " + p + " y")])).collect()
    assert {r["doc_id"] for r in found} == {1, 2}
    assert all(p in texts[r["start"]:r["end"]] for r in found for texts in [long if r["doc_id"] == 1 else "x " + p + " y"])


def test_windows_are_made_once_and_texts_move_once(make, monkeypatch):
    """One pass makes the windows, one exchange brings them together, and one
    join reads the texts; no side is broadcast, so small and large inputs run
    the same plan."""
    rnd = random.Random(15)
    p = text_of(rnd, 70)
    plans, keep = [], S.stored

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(S, "stored", lambda df, name: plans.append(plan(df)) or keep(df, name))
    found = S.repeated_spans(make([(k, text_of(rnd, 40) + " " + p) for k in range(12)]))
    whole = "\n".join([*plans, plan(found)])
    assert whole.count("MapInArrow run(") == 1
    assert sum("hashpartitioning(h#" in line for line in whole.split("\n")) == 1
    assert whole.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in whole
    assert found.count() == 12


def test_equal_rows_and_a_hot_passage_change_nothing(make):
    """Rows that come twice count once; every copy of a passage in most
    documents is reported against the smallest other one."""
    rnd = random.Random(16)
    p = text_of(rnd, 60)
    rows = [(k, text_of(rnd, 30) + " | " + p + " | " + text_of(rnd, 30)) for k in range(60)]
    once = sorted(map(tuple, S.repeated_spans(make(rows)).collect()))
    assert sorted(map(tuple, S.repeated_spans(make(rows + rows[:40] + rows[:7])).collect())) == once
    whole = [r for r in once if p in rows[r[0]][1][r[1]:r[2]]]
    assert {r[0] for r in whole} == set(range(60))
    assert all(r[4] < 60 and r[5] == (r[4] < r[0]) for r in once)

"""Language labels: Viterbi against all paths, held-out accuracy, spans, odd rows."""
import itertools

import numpy as np

from riskgraph.llm import language as L
from tests.conftest import SF0001
from tests.llm.conftest import ODD


def best_paths(scores, switch):
    n, k = scores.shape
    value = {p: sum(scores[i, s] for i, s in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:]))
             for p in itertools.product(range(k), repeat=n)}
    top = max(value.values())
    return [p for p, v in value.items() if v >= top - 1e-4]


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(1)
    for n in range(1, 7):
        for _ in range(25):
            scores = rng.normal(0, 3, (n, 3)).astype(np.float32)
            assert tuple(L.viterbi(scores, 2.0)) in best_paths(scores.astype(float), 2.0)


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in L.op7_language(spark, SF0001).collect()}
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    assert len(rows) == len(docs)
    held = [d for d in docs if rows[d["doc_id"]]["held_out"] and d["lang"]]
    right = [d for d in held if rows[d["doc_id"]]["lang_pred"] == d["lang"]]
    assert held and len(right) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def _model(spark, make):
    rows = [(k, "the cat and the dog went home together", "en") for k in range(40)]
    rows += [(100 + k, "der hund und die katze gingen nach hause", "de") for k in range(40)]
    rows += [(200 + k, "кошка и собака пошли домой вместе", "ru") for k in range(40)]
    return L.fit(make([(*r, "s") for r in rows]))


def test_mixed_text_is_labelled_in_spans(spark, make):
    model = _model(spark, make)
    text = "the cat and the dog went home. кошка и собака домой! der hund und die katze gingen nach hause"
    pred, score, spans = L.label(text, L.Scorer(model))
    assert [s["lang"] for s in spans] == ["en", "ru", "de"] and pred == "de" and 0 < score < 1
    assert text[spans[1]["start"]:spans[1]["end"]] == "кошка и собака домой"
    # a script no language was learned in has no candidate
    pred, score, spans = L.label("今日は 天気", L.Scorer(model))  # in no learned script
    assert (pred, score) == (model["langs"][0], 0) and {s["lang"] for s in spans} == {"und"}


def test_odd_rows(spark, make):
    model = _model(spark, make)
    rows = ODD + [(6, "12 34 !?"), (7, "the dog " * 60000)]
    got = {(r["doc_id"], r["lang_pred"], len(r["spans"])) for r in L.identify(make(rows), model).collect()}
    assert {(1, "und", 0), (2, "und", 0), (3, "und", 0), (6, "und", 0), (7, "en", 1)} <= got
    assert L.identify(make([]), model).collect() == []
    nothing = L.fit(make([(1, "abc", None, "s")]))  # no labelled row
    assert {r["lang_pred"] for r in L.identify(make(rows[3:5]), nothing).collect()} == {"und"}


def test_stage_keeps_clean_documents(spark, make):
    rows = [(k, "the cat and the dog went home together", "en", "s") for k in range(30)]
    rows += [(50, None, "en", "s"), (51, "12345 !!", "en", "s"), (52, "今日", None, "s")]
    docs = make(rows)
    out = L.language_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(30))


def test_parts_of_the_recurrence_equal_the_whole():
    rng = np.random.default_rng(3)

    def value(x, path, switch):
        return sum(x[i, c] for i, c in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
    for _ in range(600):
        n, k, switch = int(rng.integers(1, 60)), int(rng.integers(1, 6)), float(rng.choice([0.5, 2, 5, 12]))
        x = rng.normal(0, 3, (n, k)) + np.repeat(rng.normal(0, 2, (n // 8 + 1, k)), 8, 0)[:n]
        x = np.round(x, int(rng.integers(0, 3))).astype(np.float32)
        whole = L._recurrence(x, switch, None, None)
        assert abs(value(x.astype(float), L.viterbi(x, switch).tolist(), switch) - value(x.astype(float), whole, switch)) < 1e-3


def test_words_and_scores_equal_a_plain_computation(spark, make):
    import random
    rnd = random.Random(1)
    model = _model(spark, make)
    scorer = L.Scorer(model)
    letters = "abcßéÉ 12_日кİx\n"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 5, 60]))) for _ in range(300)]
    for t, (starts, ends, rows) in zip(texts, scorer.words(texts)):
        assert list(zip(starts.tolist(), ends.tolist())) == [m.span() for m in L._LETTERS.finditer(t)]
        for a, b, row in zip(starts, ends, rows):
            may = model["scripts"].get(L.script_of(t[a:b]))
            want = np.full(len(row), L.IMPOSSIBLE, np.float32)
            if may is None:
                want[-1] = 0
            else:
                s = model["logp"][[model["grams"].get(g, len(model["grams"])) for g in L.grams(t[a:b])]].sum(axis=0)
                want[:-1][may] = np.maximum(s - s[may].max(), L.IMPOSSIBLE)[may]
            assert np.allclose(row, want, atol=1e-3)
    piece, L.PIECE = L.PIECE, 1000
    try:
        long = "the dog went home. " * 500
        assert L.label(long, scorer)[2] == [{"start": 0, "end": len(long) - 2, "lang": "en"}]
    finally:
        L.PIECE = piece


def test_stage_keeps_mixtures_of_learned_languages(spark, make):
    parts = {"en": "the cat and the dog went home together ", "de": "der hund und die katze gingen zusammen heim ",
             "fr": "le chien et le chat sont partis ensemble "}
    rows = [(k, parts[lang], lang, "s") for k, lang in enumerate([*parts] * 30)]
    mixed = parts["en"] * 4 + parts["de"] * 3 + parts["fr"] * 3
    docs = make([*rows, (200, mixed, None, "s"), (201, parts["en"] + "今日は天気がいい " * 20, None, "s")])
    kept = {r["doc_id"] for r in L.language_stage(spark, docs, "").collect()}
    assert 200 in kept and 201 not in kept and set(range(90)) <= kept

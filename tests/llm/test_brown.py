"""Class model: base scores against a plain count, the model against its
definition, and exchange on words with known classes."""
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgraph.llm import brown

WORD = re.compile("[^\x20\x09-\x0d]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(FOLD)) + [None]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def scored(make, docs):
    df = make(docs).withColumn("held_out", brown.held_out("doc_id", 7, 2)).withColumn("words", F.lit(1)).withColumn("counts", F.lit(2))
    return df, brown.class_scores(df).collect()


def base_rows(docs):
    count = Counter(t for i, text in docs if not is_held(i) for t in split(text))
    total, distinct = sum(count.values()), len(count)
    return sorted(((i, is_held(i), len(split(t)), sum(count[w] > 0 for w in split(t)), total,
                    round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in split(t)), 6)) for i, t in docs), key=str)


def sentences(n, seed=1):
    rnd = random.Random(seed)
    verbs, nouns, others = ([f"{k}{j}" for j in range(12)] for k in ("verb", "noun", "the"))
    return [(k, " ".join(w for _ in range(rnd.randint(1, 9)) for w in (rnd.choice(others), rnd.choice(nouns), rnd.choice(verbs))))
            for k in range(n)]


ODD = [(1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (None, "One two TWO Ünï"), (None, None), (10, "é日 " * 30), (11, "x" * 9000)]


def test_base_scores_and_counts(spark, make):
    docs = sentences(120) + ODD
    _, got = scored(make, docs)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == base_rows(docs)
    assert all(r.score <= 0 and r.perplexity >= 1 for r in got)


def test_chunks_do_not_change_scores(spark, make, monkeypatch):
    docs = sentences(80) + ODD
    _, whole = scored(make, docs)
    monkeypatch.setattr(brown, "CHUNK_TOKENS", 50)
    monkeypatch.setattr(brown, "PAIRS_HELD", 30)
    _, cut = scored(make, docs)
    key = lambda r: tuple(str(round(x, 6) if isinstance(x, float) else x) for x in r)
    assert sorted(map(key, whole)) == sorted(map(key, cut))


def test_held_out_texts_are_better_than_unigrams(spark, make):
    _, got = scored(make, sentences(600))
    out = [r for r in got if r.held_out]
    assert len(out) > 30
    assert sum(r.score for r in out) > 0.75 * sum(r.base_score for r in out)


def test_nothing_to_learn_from(spark, make):
    held = [(i, "a b") for i in range(100) if is_held(i)]
    _, got = scored(make, held)
    assert {(r.n_known, r.train_tokens, r.n_tokens) for r in got} == {(0, 0, 3)}
    assert scored(make, [])[1] == []


def test_model_is_a_distribution():
    logs = brown.transition_logs(np.random.default_rng(1).integers(0, 50, (20, 20)).astype(float))
    assert np.allclose((10 ** logs).sum(1), 1)


def test_best_class_is_the_one_of_highest_likelihood():
    """On a word without itself as neighbour the gain ranks classes as the
    recomputed likelihood does."""
    rng = np.random.default_rng(3)
    words, classes, size = 14, rng.integers(1, 4, 14), 6
    n = rng.integers(0, 9, (words, words))
    np.fill_diagonal(n, 0)

    def pairs(c):
        out = np.zeros((size, size))
        for a, b in itertools.product(range(words), repeat=2):
            out[c[a], c[b]] += n[a, b]
        return out

    for w in range(words):
        left, right = (np.bincount(classes, x, size) for x in (n[:, w], n[w]))
        best = brown.best_class(pairs(classes), classes[w], left, right, np.arange(1, 4))
        value = {}
        for c in range(1, 4):
            moved = classes.copy()
            moved[w] = c
            value[c] = brown.likelihood(pairs(moved))
        assert value[best] >= max(value.values()) - 0.02 * abs(max(value.values()))


@pytest.mark.parametrize("seed", [1, 2])
def test_exchange_finds_word_kinds(spark, make, seed, monkeypatch):
    monkeypatch.setattr(brown, "CLASSES", 3)
    docs = make(sentences(400, seed)).selectExpr("doc_id", "false as held_out", "cast(text as binary) as text")
    chunks = brown.stored(docs.mapInArrow(brown._chunks, brown.CHUNK), "chunks")
    core = sorted({bytes(w) for r in chunks.select("words").collect() for w in r.words} - {b""})
    classes = brown.exchange(brown._neighbours(chunks, core), len(core), rounds=20)
    kinds = [w[:3] for w in core]
    agree = sum(max(Counter(k for k, c in zip(kinds, classes, strict=True) if c == own).values(), default=0) for own in set(classes.tolist()))
    assert agree >= 0.8 * len(core)


def test_words_outside_the_core_are_placed_by_their_neighbours(spark, make, monkeypatch):
    """Half of the words stand in the core, the others go to the class of their kind; words seen once do not."""
    docs = sentences(600, 5)
    known = make([*docs, (10_000, "the0 lonely verb1")]).selectExpr("doc_id", "false as held_out", "cast(text as binary) as text")
    monkeypatch.setattr(brown, "CHUNK_TOKENS", 200)
    monkeypatch.setattr(brown, "ROWS_PLACED", 7)
    monkeypatch.setattr(brown, "CLASSES", 3)
    chunks = brown.stored(known.mapInArrow(brown._chunks, brown.CHUNK), "chunks")
    count = Counter(t for _, text in [*docs, (0, "the0 lonely verb1")] for t in split(text) if t)
    core = sorted((w.encode(), n) for w, n in count.items() if w[-1] in "024" and w[-2:] != "10")
    kind = {"the": 1, "nou": 2, "ver": 3}
    classes = np.array([kind[w[:3].decode()] for w, _ in core])
    neighbours = brown._neighbours(chunks, [w for w, _ in core])
    pairs = brown.class_pairs(neighbours, np.concatenate([classes, [brown.END, brown.RARE]]), len(core))
    got = {bytes(r["word"]).decode(): (r["n"], r["class"]) for r in brown._classed(chunks, core, classes, pairs, len(docs) + 1).collect()}
    assert got == {"": (len(docs) + 1, brown.END), "lonely": (1, brown.RARE),
                   **{w: (n, kind[w[:3]]) for w, n in count.items() if w != "lonely"}}


def test_scores_know_the_order_of_words_outside_the_core(spark, make, monkeypatch):
    """Rare kinds follow each other in one order; their counts do not tell it."""
    rnd = random.Random(7)
    def phrase(rare):
        return " ".join(f"{k}{rnd.randrange(4) if rnd.random() > rare else rnd.randrange(4, 60)}" for k in ("the", "noun", "verb"))
    docs = [(k, " ".join(phrase(0.3) for _ in range(5))) for k in range(900)]
    docs = [d for d in docs if not is_held(d[0])]
    tests = [i for i in range(20_000, 20_200) if is_held(i)][:2]
    right = [w for k in range(10, 20) for w in (f"the{k}", f"noun{k}", f"verb{k}")]
    docs += [(tests[0], " ".join(right)), (tests[1], " ".join(reversed(right)))]
    monkeypatch.setattr(brown, "CORE", 100)
    monkeypatch.setattr(brown, "CLASSES", 6)
    _, got = scored(make, docs)
    score = {r.doc_id: r.score for r in got if r.held_out}
    assert score[tests[0]] > score[tests[1]] + 5


def test_placing_gains_what_best_class_does():
    """A word from the class of all others, whose own row takes no part."""
    rng = np.random.default_rng(4)
    size = brown.RARE + 1
    pairs = rng.integers(0, 50, (size, size)).astype(float)
    word = np.repeat(np.arange(30), rng.integers(2, 40, 30))
    left, right = rng.integers(0, brown.RARE, (2, len(word)))
    choices = np.arange(1, brown.CLASSES + 1)
    want = [brown.best_class(pairs, brown.RARE, *(np.bincount(x[word == w], minlength=size) for x in (left, right)), choices) for w in range(30)]
    assert brown.places(pairs, word, left, right).tolist() == want

"""Language identification of mixed-language text.

A word is a run of letters.  Its script (from fixed code point ranges) narrows
the languages that can own it to those seen in that script while learning.
Each candidate scores the word by its letter trigrams; a Viterbi pass over the
words, with a penalty for each change of language, labels spans.  The
document's language is the one with the most letters.

The trigram model is fitted on a bounded sample of labelled rows
(``SAMPLE_PER_LANG`` expected per language) and holds at most ``MAX_GRAMS``
trigrams for each label seen, so its size depends on the number of languages
only; every document is labelled whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.llm.common import measured_side, prepare, ship, stored, table
from riskgraph.llm.textbytes import run_hashes

ship(__name__)

SAMPLE_PER_LANG = 2000
MAX_GRAMS = 40_000
SWITCH = 12.0        # nats paid for each change of language
IMPOSSIBLE = -60.0   # score of a word for a language that does not use its script
UND = "und"
CACHE = 300_000      # scored words a task remembers (about 10 MB)
KEEP_SCORE = 0.5     # the pipeline rejects documents with a lower share of letters in learned languages

_LETTERS = re.compile(r"[^\W\d_]+")
_NO_LETTER = re.compile(r"[\W\d_]")
PIECE = 1 << 19      # characters scored at once

# First code point of each range and its script (Unicode blocks).
_RANGES = [
    (0x0000, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
]
_STARTS = [r[0] for r in _RANGES]


def fold(c: str) -> str:
    """One lower-case character for each character."""
    return c.lower()[0]


def script_of(word: str) -> str:
    """Script of a word's first letter."""
    return _RANGES[bisect_right(_STARTS, ord(fold(word[0]))) - 1][1]


def grams(word: str) -> list[str]:
    w = f" {''.join(map(fold, word))} "
    return [w[i:i + 3] for i in range(len(w) - 2)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, item, n): trigrams and scripts of the sampled texts."""
    for batch in batches:
        seen: Counter = Counter()
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            for word, n in Counter(_LETTERS.findall(text or "")).items():
                seen[lang, "script", script_of(word)] += n * len(word)
                for g in grams(word):
                    seen[lang, "gram", g] += n
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array(list(seen.values()), pa.int64())],
            ["lang", "kind", "item", "n"])


def fit(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG, max_grams: int = MAX_GRAMS) -> dict:
    """Model from rows (doc_id, text, lang).  About ``per_lang`` rows of each
    label are used, chosen by a hash of doc_id; null lang is left out.  Every
    label is learned, ``und`` as well if rows carry it."""
    labelled = labelled.filter("lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    counts = stored(labelled.groupBy("lang").agg(F.count("*").alias("rows")), "labels")
    chance = F.expr(f"{per_lang}D / rows * 4294967296D")
    sample = (labelled.join(measured_side(counts), "lang")
              .filter(F.expr("xxhash64(doc_id, 7) & 4294967295") < chance).select("text", "lang"))
    found = (sample.mapInArrow(_count, "lang string, kind string, item string, n long")
             .groupBy("kind", "item", "lang").agg(F.sum("n").alias("n")))
    scripts = found.filter("kind = 'script'").collect()
    langs = sorted({r.lang for r in scripts})
    if not langs:
        return {"langs": [], "scripts": {}, "grams": {}, "logp": np.zeros((1, 0), np.float32)}
    top = (found.filter("kind = 'gram'").groupBy("item").agg(F.sum("n").alias("total"),
                                                              F.collect_list(F.struct("lang", "n")).alias("by"))
           .orderBy(F.desc("total"), "item").limit(max_grams).collect())
    index = {r["item"]: k for k, r in enumerate(top)}
    table_ = np.full((len(top) + 1, len(langs)), 0.5)  # the last row is any other trigram
    for k, r in enumerate(top):
        for x in r["by"]:
            table_[k, langs.index(x.lang)] += x.n
    logp = np.log(table_ / table_.sum(axis=0)).astype(np.float32)
    use: dict[str, np.ndarray] = {}
    letters = Counter()
    for r in scripts:
        letters[r.lang] += r.n
    for r in scripts:  # a script counts as used from one letter in a hundred
        if r.n * 100 >= letters[r.lang]:
            use.setdefault(r["item"], np.zeros(len(langs), bool))[langs.index(r.lang)] = True
    return {"langs": langs, "scripts": use, "grams": index, "logp": logp}


class Scorer:
    """Per-word scores over the model's languages and, last, none of them.  Words are found
    and looked up with array operations; each distinct word is scored once and
    remembered by a 64-bit hash of its folded letters."""

    def __init__(self, model: dict):
        self.langs = [*model["langs"], UND]
        self.k = len(self.langs)
        points = np.array([[ord(c) for c in g] for g in model["grams"]], np.uint64).reshape(-1, 3)
        keys = self._keys(points[:, 0], points[:, 1], points[:, 2])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.logp = np.vstack([model["logp"][:-1][order], model["logp"][-1:]])  # last: any other trigram
        scripts = sorted({r[1] for r in _RANGES})
        self.may = np.zeros((len(scripts), self.k - 1), bool)
        for name, langs in model["scripts"].items():
            self.may[scripts.index(name)] = langs
        self.script_id = {name: i for i, name in enumerate(scripts)}
        # By code point, filled as characters are met: 0 not met, 1 no letter, 2 letter.
        self.kind = np.zeros(0x110000, np.uint8)
        self.folded = np.zeros(0x110000, np.uint32)
        self.script = np.zeros(0x110000, np.uint8)
        self.clear()

    @staticmethod
    def _keys(a, b, c):
        return (a.astype(np.uint64) << np.uint64(42)) | (b.astype(np.uint64) << np.uint64(21)) | c.astype(np.uint64)

    def clear(self):
        self.known = np.empty(0, np.uint64)
        self.rows = np.empty((0, self.k), np.float32)

    def _meet(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kind[points]
        if not kinds.all():
            for p in np.unique(points[kinds == 0]).tolist():
                c = chr(p)
                letter = c.isalnum() and not c.isdecimal()
                self.kind[p] = 1 + letter
                self.folded[p] = ord(fold(c))
                self.script[self.folded[p]] = self.script_id[script_of(c)]
            kinds = self.kind[points]
        return kinds

    def _score(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, scripts: np.ndarray) -> np.ndarray:
        """Scores of the words [start, end) of folded ``points``."""
        sizes = ends - starts
        total = np.cumsum(sizes)
        # The words' letters side by side, a space at either end of each.
        at = np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1])
        mid = points[at]
        left = np.where(np.arange(len(at)) == np.repeat(total - sizes, sizes), 32, points[at - 1])
        right = np.where(np.arange(len(at)) == np.repeat(total - 1, sizes), 32, points[np.minimum(at + 1, len(points) - 1)])
        keys = self._keys(left, mid, right)
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        hit = self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), bool)
        row = np.where(hit, place, len(self.keys))
        s = np.add.reduceat(self.logp[row], total - sizes, axis=0) if self.k > 1 else np.empty((len(starts), 0), np.float32)
        may = self.may[scripts]
        out = np.full((len(starts), self.k), IMPOSSIBLE, np.float32)
        some = may.any(axis=1)
        out[~some, -1] = 0.0
        top = np.where(may, s, -np.inf).max(axis=1, initial=-np.inf)[:, None]
        out[:, :-1] = np.where(may, np.maximum(s - np.where(some[:, None], top, 0), IMPOSSIBLE), IMPOSSIBLE)
        return out

    def words(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(starts, ends, scores) of the words of each text."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        cut = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if not len(points):
            return [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, self.k), np.float32))] * len(texts)
        inside = np.zeros(len(points) + 1, bool)
        inside[:-1] = self._meet(points) == 2
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        edges = cut[1:-1]
        begin[edges[inside[edges]]] = True  # a text's end ends a word
        starts = np.flatnonzero(begin)
        stop = np.flatnonzero(~inside)
        ends = stop[np.searchsorted(stop, starts)]
        ends = np.minimum(ends, cut[np.searchsorted(cut, starts, "right")])
        if not len(starts):
            return [(starts, ends, np.empty((0, self.k), np.float32))] * len(texts)
        points = self.folded[points]
        distinct, first, back = np.unique(run_hashes(points, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > CACHE:
            self.clear()
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        have = place < len(self.known)
        new[have] = self.known[place[have]] != distinct[have]
        if new.any():
            w = first[new]
            made = self._score(points, starts[w], ends[w], self.script[points[starts[w]]])
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.rows = known[order], np.concatenate([self.rows, made])[order]
            place = np.searchsorted(self.known, distinct)
        scores = self.rows[place[back]]
        upto = np.searchsorted(starts, cut)
        return [(starts[a:z] - c, ends[a:z] - c, scores[a:z]) for a, z, c in zip(upto, upto[1:], cut, strict=False)]


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label per word, with a penalty for each change of label.

    The recurrence runs only where it can leave the best single label ``home``.
    Let G be the running gain of the best other label over ``home``.  A stretch
    away from home gains nothing by crossing a place where G is the least so
    far (it could as well begin there), once G has fallen by a switch's cost;
    such places cut the words into parts, and a part in which G never rises by
    more than a switch stays at home.
    """
    n, k = scores.shape
    home = int(scores.sum(axis=0, dtype=np.float64).argmax())
    path = np.full(n, home, np.int64)
    if k == 1:
        return path
    gain = np.max(np.delete(scores, home, axis=1), axis=1).astype(np.float64) - scores[:, home]
    total = np.concatenate([[0.0], np.cumsum(gain)])
    least = np.minimum.accumulate(total)
    rise = total - least
    if rise.max() <= switch:
        return path
    new = np.concatenate([[False], least[1:] < least[:-1]]) & (total <= -switch)
    edges = np.unique(np.concatenate([[0], np.flatnonzero(new), [n]]))
    high = np.maximum.reduceat(rise, edges[:-1])
    # reduceat takes [a, b); the rise at b itself is nought unless b ends the text
    high[-1] = max(high[-1], rise[n])
    for a, b in zip(edges[:-1][high > switch].tolist(), edges[1:][high > switch].tolist(), strict=True):
        path[a:b] = _recurrence(scores[a:b], switch, home if a else None, home if b < n else None)
    return path


def _recurrence(scores: np.ndarray, switch: float, before: int | None, after: int | None) -> list[int]:
    """Best labels of some words between words of label ``before`` and ``after``
    (None: the text begins or ends)."""
    rows = scores.astype(np.float64)
    for edge, label_ in ((0, before), (-1, after)):
        if label_ is not None:
            away = np.arange(rows.shape[1]) != label_
            rows[edge, away] -= switch
    rows = rows.tolist()
    state, back = rows[0], []
    for row in rows[1:]:
        top = max(state)
        j = state.index(top)
        top -= switch
        back.append([i if s >= top else j for i, s in enumerate(state)])
        state = [r + (s if s >= top else top) for r, s in zip(row, state)]  # noqa: B905
    at = state.index(max(state))
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    return path[::-1]


def _pieces(text: str) -> list[str]:
    """A long text in pieces that end outside words."""
    out, at = [], 0
    while len(text) - at > PIECE:
        gap = _NO_LETTER.search(text, at + PIECE)
        end = gap.end() if gap else len(text)
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


def _judge(starts: np.ndarray, ends: np.ndarray, scores: np.ndarray, langs: list[str], switch: float) -> tuple:
    if not len(starts):
        return UND, 0.0, [], 0.0
    path = viterbi(scores, switch)
    sizes = ends - starts
    letters = np.bincount(path, weights=sizes, minlength=len(langs))
    best = int(letters[:-1].argmax()) if len(langs) > 1 else 0  # the first learned one if none owns a letter
    cuts = np.flatnonzero(np.diff(path)) + 1
    firsts, lasts = np.concatenate([[0], cuts]), np.concatenate([cuts - 1, [len(path) - 1]])
    spans = [{"start": int(starts[a]), "end": int(ends[b]), "lang": langs[path[a]]} for a, b in zip(firsts, lasts, strict=True)]
    share = letters / sizes.sum()
    return langs[best], float(share[best]) if len(langs) > 1 else 0.0, spans, float(share[:-1].sum())


def label_all(texts: list[str | None], scorer: Scorer, switch: float = SWITCH) -> list[tuple[str, float, list[dict], float]]:
    """(language, its share of letters, spans, share of letters in any learned
    language) of each whole text."""
    texts = [t or "" for t in texts]
    out, a = [], 0
    while a < len(texts):
        z, chars = a, 0
        while z < len(texts) and (z == a or chars + len(texts[z]) <= PIECE):
            chars += len(texts[z])
            z += 1
        if chars > PIECE:  # one long text
            found, at = [], 0
            for piece in _pieces(texts[a]):
                s, e, x = scorer.words([piece])[0]
                found.append((s + at, e + at, x))
                at += len(piece)
            out.append(_judge(*(np.concatenate(c) for c in zip(*found, strict=True)), scorer.langs, switch))
        else:
            out += [_judge(*w, scorer.langs, switch) for w in scorer.words(texts[a:z])]
        a = z
    return out


def label(text: str | None, scorer: Scorer, switch: float = SWITCH) -> tuple[str, float, list[dict]]:
    return label_all([text], scorer, switch)[0][:3]


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def identify(docs: DataFrame, model: dict, switch: float = SWITCH) -> DataFrame:
    """Rows (doc_id, lang_pred, score, spans) for ``docs`` (doc_id, text).

    spans are (start, end, lang) in code points, end exclusive, from the first
    to the last letter of each run of words with one label; words that no
    learned language can own are ``und`` there.  Null texts and texts without a
    letter are ``und`` with score 0 and no spans; so is every text if nothing
    was learned.  A text whose letters are in no learned language has the first
    learned one with score 0.  Ties go to the first language by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_GRAMS rows

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = label_all(batch.column("text").to_pylist(), scorer, switch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], _SPAN)],
                ["doc_id", "lang_pred", "score", "spans"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>")


def _fold():
    return F.crc32(F.col("doc_id").cast("string")) % 5


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit(docs.filter(_fold() != 0))
    return identify(docs, model).select(
        "doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"], s["lang"])), ",").alias("spans"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: a document goes if it has no letter, or the learned
    languages together own less than ``KEEP_SCORE`` of its letters; a mixture
    of them stays.  All columns pass through the labelling
    task, so texts are neither joined nor shuffled."""
    prepare(spark)
    model = fit(docs.select("doc_id", "text", "lang").filter(_fold() != 0))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = label_all(batch.column("text").to_pylist(), scorer)
            yield batch.filter(pa.array([share >= KEEP_SCORE for *_, share in found], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)

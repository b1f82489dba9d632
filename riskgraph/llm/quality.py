"""Quality rules with adaptive thresholds.

Each text gives a few whole-number features.  Per (lang, source) a quantile
sketch of each feature is kept: counts in logarithmic buckets, so two sketches
merge by adding counts and a quantile is off by at most the bucket width
(``GAMMA``).  From a group's quartiles follow its fences; a document outside
its group's fences fails.  A group of fewer than ``LEAST_GROUP`` documents
uses the merged sketch of its language, or of all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import prepare, ship, small_side, stored, table
from riskgraph.llm.textbytes import batch_bytes, doc_words, mix64, spaces

ship(__name__)

GAMMA = 1.02          # ratio of neighbouring bucket bounds
LEAST_GROUP = 100     # documents a group needs for thresholds of its own
REACH = 3             # fences lie this many quartile distances beyond the quartiles
# Feature: (SQL over the counts, sides tested, least quartile distance).  The
# least distance keeps a feature that is almost constant in a group from
# condemning small deviations.
FEATURES = {
    "word_length": ("1000 * word_chars div n_words", "both", 500),   # code points per 1000 words
    "symbols": ("1000 * n_symbols div n_words", "high", 50),
    "dup_lines": ("1000 * n_dup_lines div n_lines", "high", 70),
    "repeats": ("1000 * n_repeat_words div n_words", "high", 70),
}
NONE = "(none)"  # stands for a null lang or source

# Fixed values of the contract.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
BASE_LEAST_WORDS = 50


def _repeat_words(words: np.ndarray) -> int:
    """Words inside 3-word windows found twice or more, first included."""
    if len(words) < 4:
        return 0
    h = mix64(words[:-2] + np.uint64(3) * mix64(words[1:-1] + np.uint64(5) * mix64(words[2:])))
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(words), bool)
    for k in range(3):
        cover[k:k + len(h)] |= again
    return int(cover.sum())


def _lines(text: bytes) -> tuple[int, int]:
    """(lines with a word, of them equal to an earlier line)."""
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            n += 1
            seen.add(line)
    return n, n - len(seen)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = batch_bytes(batch.column("text"))
        out = np.zeros((6, batch.num_rows), np.int64)
        for i, words in doc_words(data, offsets, fold=False):
            raw = data[offsets[i]:offsets[i + 1]]
            chars = sum(int((~spaces(p) & ((p & 0xC0) != 0x80)).sum()) for p in np.array_split(raw, 1 + len(raw) // (1 << 22)))
            out[:, i] = (len(words), chars, _SYMBOL[raw].sum(), 0, 0, _repeat_words(words))
            out[3:5, i] = _lines(raw.tobytes())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "lang", "source")), *(pa.array(r) for r in out)],
            ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"])


def measure(docs: DataFrame) -> DataFrame:
    """Counts of each whole text; a null text has no word and no line."""
    return docs.select(F.col("doc_id").cast("long"), "text", F.coalesce("lang", F.lit(NONE)).alias("lang"),
                       F.coalesce("source", F.lit(NONE)).alias("source")).mapInArrow(
        _measure, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
                  "n_lines long, n_dup_lines long, n_repeat_words long")


def sketches(values: DataFrame) -> DataFrame:
    """Sketch rows (lang, source, feature, bucket, n) of rows with the features."""
    long = values.select("lang", "source", F.expr("stack({}, {}) as (feature, v)".format(
        len(FEATURES), ", ".join(f"'{f}', cast({f} as long)" for f in FEATURES))))
    bucket = F.when(F.col("v") == 0, F.lit(0)).otherwise(
        F.floor(F.log(F.col("v").cast("double")) / math.log(GAMMA)).cast("long") + 1)
    return long.withColumn("bucket", bucket).groupBy("lang", "source", "feature", "bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups: counts of the same bucket added."""
    return sketch.groupBy(*keys, "feature", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, feature, total, low, high) from the quartiles of each sketch."""
    group = Window.partitionBy(*keys, "feature")
    upto = F.sum("n").over(group.orderBy("bucket"))
    value = F.expr(f"if(bucket = 0, 0L, cast(floor(pow({GAMMA}D, bucket - 0.5D)) as long))")
    q = (sketch.withColumn("upto", upto).withColumn("total", F.sum("n").over(group)).withColumn("value", value)
         .groupBy(*keys, "feature").agg(
             F.first("total").alias("total"),
             F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("value"))).alias("q1"),
             F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("value"))).alias("q3")))
    least = F.expr("case feature " + " ".join(f"when '{f}' then {x[2]}L" for f, x in FEATURES.items()) + " end")
    spread = F.greatest(F.col("q3") - F.col("q1"), least)
    return q.select(*keys, "feature", "total", (F.col("q1") - REACH * spread).alias("low"),
                    (F.col("q3") + REACH * spread).alias("high"))


def _wide(f: DataFrame, mark: str, *keys: str) -> DataFrame:
    cols = [F.first("total").alias(f"{mark}_total")]
    for name in FEATURES:
        for side in ("low", "high"):
            cols.append(F.max(F.when(F.col("feature") == name, F.col(side))).alias(f"{mark}_{name}_{side}"))
    return f.groupBy(*keys).agg(*cols)


def thresholds(sketch: DataFrame) -> DataFrame:
    """Per (lang, source): low and high of every feature, from the group's own
    sketch if it has ``LEAST_GROUP`` documents, else its language's, else all."""
    own = _wide(fences(sketch, "lang", "source"), "g", "lang", "source")
    lang = _wide(fences(merged(sketch, "lang"), "lang"), "l", "lang")
    every = _wide(fences(merged(sketch)), "a")
    pick = [F.expr(f"case when g_total >= {LEAST_GROUP} then g_{n}_{s} when l_total >= {LEAST_GROUP} then l_{n}_{s} "
                   f"else a_{n}_{s} end").alias(f"{n}_{s}") for n in FEATURES for s in ("low", "high")]
    return own.join(lang, "lang").join(every.withColumn("one", F.lit(1)), F.col("one") == 1).select("lang", "source", *pick)


def judge(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang, source): the counts,
    base_failed, and kept: false if base_failed, else whether every feature
    lies inside its group's fences.  Base failures are not in the sketches.
    Null or empty texts have zeros and fail; repeated rows are judged alike."""
    values = measure(docs).withColumn("base_failed", F.expr(
        f"n_words < {BASE_LEAST_WORDS} or 100 * n_repeat_words > 50 * n_words"))
    for name, (sql, _, _) in FEATURES.items():
        values = values.withColumn(name, F.when(F.col("n_words") > 0, F.expr(sql)).otherwise(F.lit(0)))
    values = stored(values, "measures")
    limits = stored(thresholds(stored(sketches(values.filter("not base_failed")), "sketches")), "thresholds")
    inside = F.lit(True)
    for name, (_, side, _) in FEATURES.items():
        inside = inside & (F.col(name) <= F.col(f"{name}_high"))
        if side == "both":
            inside = inside & (F.col(name) >= F.col(f"{name}_low"))
    return (values.join(small_side(limits, 160), ["lang", "source"], "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def _duck_fences(keys: str, name: str) -> str:
    part = f"PARTITION BY {keys}feature"
    case = " ".join(f"WHEN '{f}' THEN {x[2]}" for f, x in FEATURES.items())
    return f"""{name} AS (
  SELECT {keys}feature, total, q1 - {REACH} * greatest(q3 - q1, least) AS low, q3 + {REACH} * greatest(q3 - q1, least) AS high
  FROM (
    SELECT {keys}feature, any_value(total) AS total, min(value) FILTER (upto * 4 >= total) AS q1,
           min(value) FILTER (upto * 4 >= total * 3) AS q3, CASE feature {case} END AS least
    FROM (
      SELECT *, CASE WHEN bucket = 0 THEN 0 ELSE CAST(floor(pow(CAST({GAMMA} AS DOUBLE), bucket - CAST(0.5 AS DOUBLE))) AS BIGINT) END AS value,
             sum(n) OVER ({part} ORDER BY bucket) AS upto, sum(n) OVER ({part}) AS total
      FROM (SELECT {keys}feature, bucket, sum(n) AS n FROM sketch GROUP BY {keys}feature, bucket)
    ) GROUP BY {keys}feature
  )
)"""


_STACK = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, base_failed, '{f}' AS feature, CASE WHEN n_words = 0 THEN 0 ELSE {x[0].replace(' div ', ' // ')} END AS v, "
    f"{'true' if x[1] == 'both' else 'false'} AS two FROM m" for f, x in FEATURES.items())
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g
  FROM d WHERE len(w) > 2
), twice AS (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams SEMI JOIN twice USING (doc_id, g)) GROUP BY doc_id
), lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM lines
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, lang, source, len(w) AS n_words, coalesce(CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w) AS base_failed
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id)
), f AS ({_STACK}),
sketch AS (
  SELECT lang, source, feature, CASE WHEN v = 0 THEN 0 ELSE CAST(floor(ln(CAST(v AS DOUBLE)) / CAST({math.log(GAMMA)!r} AS DOUBLE)) AS BIGINT) + 1 END AS bucket,
         count(*) AS n
  FROM f WHERE NOT base_failed GROUP BY ALL
), {_duck_fences("lang, source, ", "own")}, {_duck_fences("lang, ", "by_lang")}, {_duck_fences("", "every")},
verdict AS (
  SELECT f.doc_id, bool_and(f.v <= CASE WHEN own.total >= {LEAST_GROUP} THEN own.high WHEN by_lang.total >= {LEAST_GROUP} THEN by_lang.high ELSE every.high END
      AND (NOT two OR f.v >= CASE WHEN own.total >= {LEAST_GROUP} THEN own.low WHEN by_lang.total >= {LEAST_GROUP} THEN by_lang.low ELSE every.low END)) AS inside
  FROM f JOIN own USING (lang, source, feature) JOIN by_lang USING (lang, feature) JOIN every USING (feature) GROUP BY f.doc_id
)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, false) AS kept
FROM m LEFT JOIN verdict USING (doc_id)
"""

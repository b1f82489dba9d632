"""URL filter: rules first, then naive Bayes over segmented names.

Host labels and path parts are often words run together.  A unigram model of
the pages' own visible words splits their letter runs by Viterbi.  Pages decided
by a rule are the training rows of a multinomial naive Bayes over the words of
host and path; all other pages get its verdict.

The model has every word of the pages, however many there are, and stays a
table: the substrings of the distinct letter runs are joined with it, and each
run is split by a small dictionary of its own.  The Bayes counts meet the pages'
tokens in a join, too.  No join is left to Spark's estimates: sides are broadcast
by their measured rows or merged, so the driver holds no table that grows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.llm.common import discard, measured_join, prepare, salted_join, ship, stored, table

ship(__name__)

# Fixed values of the contract: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LONGEST_WORD = 24
WORD = r"\p{L}+"
TOKEN = r"[\p{L}]+|[0-9]+"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls.  A rule
    fits its host and all subdomains where the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) of the visible words of all pages, lower-cased."""
    seen = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return (pages.select(F.explode(F.regexp_extract_all(F.lower(seen), F.lit(WORD), F.lit(0))).alias("word"))
            .groupBy("word").agg(F.count("*").alias("n")))


def segment(name: str, logp: dict[str, float], unknown: float) -> list[str]:
    """Most likely split of ``name`` into words; a stretch of letters that is
    no word costs ``unknown`` for each letter and once more for the stretch."""
    n = len(name)
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            word = name[start:end]
            p = logp.get(word)
            score = best[start] + (p if p is not None else unknown * (1 + end - start))
            if score > best[end]:
                best[end], back[end] = score, start
    out, end = [], n
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def _segment_rows(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = -math.log(total + 1)
        for batch in batches:
            words = []
            for name, found in zip(batch.column("run").to_pylist(), batch.column("found").to_pylist(), strict=True):
                words.append(segment(name, {f["word"]: math.log(f["n"] / total) for f in found or []}, unknown))
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(words, pa.list_(pa.string()))], ["run", "words"])
    return run


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words) for distinct ``names`` under the unigram model of
    ``words`` (word, n): runs of letters are split, runs of digits stay whole,
    anything else separates (stored)."""
    words = stored(words.filter(F.length("word") <= LONGEST_WORD), "words")
    total = words.agg(F.sum("n")).first()[0] or 1
    parts = stored(names.select("name", F.posexplode(F.regexp_extract_all(F.lower("name"), F.lit(TOKEN), F.lit(0))).alias("k", "run")), "runs")
    runs = parts.select("run").filter(F.col("run").rlike("^" + WORD)).distinct()
    # Characters of a run, then its substrings up to the longest word.
    letters = runs.select("run", F.split("run", "").alias("c")).select("run", F.explode(F.expr("sequence(1, length(run))")).alias("at"), "c")
    inside = letters.select("run", F.expr(f"slice(c, at, {LONGEST_WORD})").alias("c")).select("run", F.explode(F.expr(
        "transform(sequence(1, size(c)), n -> array_join(slice(c, 1, n), ''))")).alias("word")).filter("word != ''").distinct()
    inside = stored(inside, "substrings")
    asked = stored(inside.select("word").distinct(), "asked-words")
    known = stored(measured_join(words, asked, "word"), "known")
    found = (salted_join(inside, known, "word", "run").groupBy("run")
             .agg(F.collect_list(F.struct("word", "n")).alias("found")))
    split = stored(runs.join(found.hint("merge"), "run", "left").mapInArrow(_segment_rows(total), "run string, words array<string>"), "split")
    whole = salted_join(parts.select("name", "k", "run"), split, "run", "name", how="left").withColumn(
        "words", F.coalesce("words", F.array("run")))
    out = stored(whole.groupBy("name").agg(F.expr("flatten(transform(array_sort(collect_list(struct(k, words))), x -> x.words))").alias("words")), "segments")
    discard(words, parts, inside, asked, known, split)
    return out


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, host, path, rule,
    verdict, host_words, score (log odds of block; null where a rule decides).

    Null urls and urls without ``://`` have empty host and path, fit no rule
    and are judged by the class prior alone; ties allow.  With no rule-decided
    page of a class, its prior counts as one page.  A token counts as often as
    it stands in a url.  Repeated rows repeat.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))

    # Distinct (host, path) pairs carry the work; equal urls are judged once.
    pairs = stored(parsed.groupBy("host", "path", "by_rule").agg(F.count("*").alias("n")), "pairs")
    parts = pairs.select("host", "path", "by_rule", "n", F.explode(F.concat(
        F.transform(F.split("host", r"\."), lambda x: F.struct(F.lit("h").alias("side"), x.alias("name"))),
        F.transform(F.split("path", "/"), lambda x: F.struct(F.lit("p").alias("side"), x.alias("name"))))).alias("t"))
    parts = parts.select("host", "path", "by_rule", "n", "t.side", "t.name").filter("name != ''")
    words = segmented(parts.select("name").distinct(), word_counts(pages))
    tokens = stored(salted_join(parts, words, "name", "path").select(
        "host", "path", "by_rule", "n", F.explode("words").alias("w"), "side")
        .select("host", "path", "by_rule", "n", F.concat("side", F.lit(":"), "w").alias("token")), "tokens")

    known = tokens.filter("by_rule is not null")
    counts = known.groupBy("token").agg(F.sum(F.expr("if(by_rule = 'block', n, 0)")).alias("b"),
                                        F.sum(F.expr("if(by_rule = 'allow', n, 0)")).alias("a"))
    counts = stored(counts, "bayes")
    t = counts.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    nb, na, v = t[0] or 0, t[1] or 0, t[2]
    rows = {r["by_rule"]: r["n"] for r in pairs.groupBy("by_rule").agg(F.sum("n").alias("n")).collect()}
    prior = math.log(rows.get("block") or 1) - math.log(rows.get("allow") or 1)
    odds = counts.select("token", F.expr(f"ln((b + 1D) / {nb + v + 1}D) - ln((a + 1D) / {na + v + 1}D)").alias("odds"))
    scores = (salted_join(tokens.filter("by_rule is null"), odds, "token", "path")
              .groupBy("host", "path").agg(F.sum("odds").alias("odds")))
    names = (words.select(F.col("name"), "words"))
    hosts = (pairs.select("host", F.posexplode(F.split("host", r"\.")).alias("k", "name")).distinct()
             .transform(lambda df: salted_join(df, names, "name", "host", how="left")).groupBy("host").agg(F.sort_array(F.collect_set(F.struct("k", "words"))).alias("s"))
             .select("host", F.expr("array_join(flatten(transform(filter(s, x -> x.words is not null), x -> x.words)), ' ')").alias("host_words")))
    judged = stored(pairs.filter("by_rule is null").select("host", "path").join(scores.hint("merge"), ["host", "path"], "left")
                    .select("host", "path", (F.coalesce("odds", F.lit(0.0)) + F.lit(prior)).alias("score")), "judged")
    return (measured_join(measured_join(parsed, judged, ["host", "path"], "left"), stored(hosts, "hosts"), "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("by_rule", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
                    F.coalesce("host_words", F.lit("")).alias("host_words"), F.when(F.col("by_rule").isNull(), F.col("score")).alias("score")))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return judge(table(spark, sf_dir, "pages", "page_id", "url", "html"))

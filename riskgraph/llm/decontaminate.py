"""Benchmark decontamination with a positional inverted index.

The index holds (term, text, position) postings of the training tokens.  Only
terms that some test phrase looks up are stored: per phrase its rarest words by
their count in the whole corpus, as many as let two of them stand in every match
(a proximity match may miss a fifth of the words).

A match lies in a run of ``width + 2 * slop`` words.  Positions are put into
overlapping ranges of twice that length, so every such run lies whole in one.
The posting lists are intersected on (text, segment of a test text, range): the
segment's words that stand in a range are a set of bits, and a phrase is left in
the ranges that have two of its own.  The range's words are then compared with
it: word by word (phrase match), or by the share of the phrase's distinct words
in a run (proximity match).

Everything is DataFrame operations.  Postings are shuffled once, by text; all
else about a text stays where they are.  Texts are keyed by two 64-bit hashes,
so copies meet in one key, and their postings are joined before the shuffle.  Words of the index are known by a 64-bit hash; every
match is compared by its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import discard, measured_side, prepare, stored, table

WIDTH = 10      # words in a test phrase
SLOP = 3        # words by which a proximity match's run is longer at each end
NEAR_SHARE = 80  # per cent of a phrase's distinct words in a proximity match
SEGMENT = 32    # phrases of a test text that are searched together

# Fixed values of the contract: words are runs of anything but these ASCII
# ranges; A-Z are letters here because they are lower-cased before.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased, as compared."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _folded(text: Column) -> Column:
    """Text as the index folds it, character by character: full lower-casing
    is several times faster than lower-casing A-Z alone and gives equal words
    for equal words.  The one letter whose lower case depends on its neighbours
    (the capital sigma) is folded first."""
    return F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))


def _search_words(text: Column) -> Column:
    """Words for the index, at the places where ``words_of`` has them."""
    return F.regexp_extract_all(_folded(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _text_key() -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text: the second starts from another
    seed, as the constant goes first."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _keyed(docs: DataFrame) -> DataFrame:
    k1, k2 = _text_key()
    return docs.select("doc_id", "text", k1.alias("k1"), k2.alias("k2"))


def _phrases(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Phrases (seg, at, words) of the distinct test texts and the owners of
    the texts' segments (seg, item_id), stored.  A segment is some neighbouring
    phrases of one text, named by a 64-bit hash of all its words and their place
    (the test set is small)."""
    w = items.select("item_id", words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0))))
    w = w.select("item_id", "w", at.alias("at"))
    # The words that a segment looks up must fit the bits of a long.
    seg = F.xxhash64(F.array_join("w", " "), F.floor(F.col("at") / max(1, min(SEGMENT, 64 - width))))
    w = stored(w.select("item_id", seg.alias("seg"), "at", F.expr(f"slice(w, at + 1, {width})").alias("words")), "phrases")
    return (w.select("seg", "at", "words").dropDuplicates(["seg", "at"]), w.select("seg", "item_id").distinct())


def _lookups(texts: DataFrame, phrases: DataFrame, near_share: int) -> tuple[DataFrame, DataFrame]:
    """(words to look up: h, seg, bit; per segment its phrases: seg, masks of
    (at, mask, sure)), stored: ``sure`` of the words of a phrase's mask stand in
    every match of it.

    A match of a phrase of ``d`` distinct words lacks at most
    ``t = d - ceil(near_share * d / 100)`` of them.  If ``u`` of them stand in
    no text, at most ``t - u`` others are missing, and of the ``t - u + 2``
    rarest others two are there.  A phrase with ``u > t`` has no match.  Counts
    cover the whole corpus."""
    d = F.size(F.array_distinct("words"))
    words = (phrases.withColumn("t", d - F.ceil(near_share * d / 100).cast("int"))
             .select("seg", "at", "t", F.explode(F.array_distinct(F.transform("words", _folded))).alias("word"))
             .select("seg", "at", "t", F.xxhash64("word").alias("h")))
    terms = stored(words, "terms")
    vocabulary = measured_side(stored(terms.select("h").distinct(), "vocabulary"))
    counts = stored(texts.select(F.explode(_search_words(F.col("text"))).alias("w")).select(F.xxhash64("w").alias("h"))
                    .join(vocabulary, "h").groupBy("h").agg(F.count("*").alias("freq")), "counts")
    phrase = Window.partitionBy("seg", "at")
    ranked = (terms.join(measured_side(counts), "h", "left")
              .withColumn("missing", F.col("t") - F.count_if(F.col("freq").isNull()).over(phrase))
              .filter("missing >= 0 and freq is not null")
              .withColumn("known", F.count("*").over(phrase))
              .withColumn("rank", F.row_number().over(phrase.orderBy("freq", "h")))
              .filter("rank <= missing + 2")
              .withColumn("sure", F.least(F.lit(2), F.least("known", F.col("missing") + 2) - F.col("missing")))
              .withColumn("bit", F.expr("shiftleft(1L, int(dense_rank() over (partition by seg order by h) - 1))")))
    ranked = stored(ranked.select("h", "seg", "at", "bit", "sure"), "ranked")
    masks = ranked.groupBy("seg", "at").agg(F.bit_or("bit").alias("mask"), F.min("sure").cast("int").alias("sure"))
    masks = stored(masks.groupBy("seg").agg(F.collect_list(F.struct("at", "mask", "sure")).alias("masks")), "masks")
    lookups = stored(ranked.select("h", "seg", "bit").distinct(), "lookups")
    discard(terms, counts, ranked)
    return lookups, masks


def _ranges(texts: DataFrame, lookups: DataFrame, masks: DataFrame, reach: int) -> DataFrame:
    """(k1, k2, seg, at, low): ranges of ``2 * reach`` words, from word ``low``
    on, that may hold a match of the phrase (stored)."""
    wanted = measured_side(stored(lookups.select("h").distinct(), "looked-up"))
    postings = (texts.select("k1", "k2", F.posexplode(_search_words(F.col("text"))).alias("pos", "w"))
                .select("k1", "k2", "pos", F.xxhash64("w").alias("h")).join(wanted, "h")
                .groupBy("k1", "k2").agg(F.collect_set(F.struct("pos", "h")).alias("p")))
    low = F.explode(F.array(F.floor(F.col("pos") / (2 * reach)) * 2 * reach,
                            F.floor((F.col("pos") + reach) / (2 * reach)) * 2 * reach - reach))
    found = (postings.select("k1", "k2", F.explode("p").alias("p")).select("k1", "k2", "p.*").join(measured_side(lookups), "h")
             .select("k1", "k2", "seg", "bit", low.alias("low"))
             .groupBy("k1", "k2", "seg", "low").agg(F.bit_or("bit").alias("bits"))
             .join(measured_side(masks), "seg")
             .select("k1", "k2", "seg", "low", F.explode(F.expr("filter(masks, m -> bit_count(bits & m.mask) >= m.sure)")).alias("m"))
             .select("k1", "k2", "seg", "m.at", "low"))
    return stored(found, "ranges")


def phrase_matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = SLOP,
                   near_share: int = NEAR_SHARE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrase matches, proximity matches, owners) of ``items`` in ``docs``.

    Phrases are all runs of ``width`` words of an item, or its whole words if
    it has fewer.  A phrase match is a run of the same words: rows (k1, k2, seg,
    at, n, start) with the text's key, the phrase, its words and the position of
    its first word.  A proximity match is a run of ``n + 2 * slop`` words (or a
    whole shorter text) that holds at least ``near_share`` per cent of the
    phrase's distinct words: rows (k1, k2, seg) for segments without a phrase
    match in that text.  owners has (seg, item_id).
    """
    texts = _keyed(docs)
    phrases, owners = _phrases(items, width)
    lookups, masks = _lookups(texts, phrases, near_share)
    reach = width + 2 * slop
    ranges = _ranges(texts, lookups, masks, reach)

    keys = measured_side(stored(ranges.select("k1", "k2").distinct(), "keys"))
    whole = (texts.join(keys, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
             .select("k1", "k2", words_of(F.col("text")).alias("w")))
    # Each range takes its own words from the text at once; ranges of one long
    # text are rows of their own.  The words are bound to a name, so that no
    # step takes them again.
    held = (whole.join(ranges, ["k1", "k2"])
            .select("k1", "k2", "seg", "at", F.greatest("low", F.lit(0)).cast("int").alias("low"), F.explode(F.array(F.expr(
                f"slice(w, int(greatest(low, 0)) + 1, int({2 * reach} + least(low, 0)))"))).alias("z"))
            .filter("size(z) > 0"))
    tried = (held.join(measured_side(stored(phrases, "distinct-phrases")), ["seg", "at"]).withColumn("n", F.size("words"))
             .filter(f"100 * size(array_intersect(z, words)) >= {near_share} * size(array_distinct(words))"))
    exact = "filter(sequence(0, greatest(size(z) - n, 0)), s -> slice(z, s + 1, n) = words)"
    near = (f"exists(sequence(0, greatest(size(z) - n - {2 * slop}, 0)), s -> 100 * size(array_intersect("
            f"slice(z, s + 1, n + {2 * slop}), words)) >= {near_share} * size(array_distinct(words)))")
    verdict = F.explode(F.array(F.struct(F.expr(exact).alias("starts"), F.expr(near).alias("near")))).alias("v")
    found = stored(tried.select("k1", "k2", "seg", "at", "n", "low", verdict).select("k1", "k2", "seg", "at", "n", "low", "v.*")
                   .filter("near or size(starts) > 0"), "matches")
    discard(ranges, lookups, masks)
    phrase = found.select("k1", "k2", "seg", "at", "n", F.explode("starts").alias("s"), "low").select(
        "k1", "k2", "seg", "at", "n", (F.col("low") + F.col("s")).alias("start")).distinct()
    close = found.filter("near").select("k1", "k2", "seg").distinct().join(
        phrase.select("k1", "k2", "seg").distinct(), ["k1", "k2", "seg"], "left_anti")
    return phrase, close, owners


def contamination(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit (words inside a
    phrase match), n_items, items_sha256, contaminated, n_near_items (items
    with a proximity match and no phrase match).  Null or wordless texts have
    zeros and the digest of an empty string; an item without words has no
    phrase; null item_ids mark words as hit and are not listed.  Repeated rows
    repeat, and so do repeated items, which count once."""
    phrase, close, owners = phrase_matches(docs, items, **how)
    key = ["k1", "k2"]
    hit = (phrase.select(*key, F.explode(F.expr("sequence(start, start + n - 1)")).alias("p"))
           .distinct().groupBy(*key).agg(F.count("*").alias("n_hit")))
    owners = measured_side(stored(owners, "owners"))
    exact = phrase.select(*key, "seg").distinct().join(owners, "seg").select(*key, "item_id").distinct()
    found = exact.groupBy(*key).agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    near = (close.join(owners, "seg").select(*key, "item_id").distinct()
            .join(exact, [*key, "item_id"], "left_anti").groupBy(*key).agg(F.count("item_id").alias("n_near_items")))
    facts = stored(hit.join(found, key, "full").join(near, key, "full"), "facts")
    items_of = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return (_keyed(docs).join(measured_side(facts), key, "left")
            .select("doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(items_of).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.sort_array(items_of), ","), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
                    F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                         table(spark, sf_dir, "benchmark", "item_id", "text"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a phrase match go, by their text."""
    prepare(spark)
    phrase, _, _ = phrase_matches(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    bad = stored(phrase.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct(), "contaminated")
    k1, k2 = _text_key()
    return docs.join(measured_side(bad), (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left_anti")


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# Proximity by its meaning: some run of n + 6 words holds 80 % of a phrase's
# distinct words; only texts that hold as many of them at all are looked at.
ORACLE = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
phrases AS (
  SELECT item_id, w[k + 1:k + 10] AS words
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS k FROM i WHERE len(w) > 0)
), owners AS (SELECT DISTINCT words, item_id FROM phrases),
starts AS (
  SELECT doc_id, k, w[k + 1:k + n] AS words, n
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS k
        FROM d CROSS JOIN (SELECT DISTINCT len(words) AS n FROM phrases) WHERE len(w) >= n)
), hits AS (SELECT doc_id, k, n, s.words FROM starts s WHERE s.words IN (SELECT words FROM owners)),
n_hit AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id
), exact AS (SELECT DISTINCT doc_id, item_id FROM hits JOIN owners USING (words)),
found AS (
  SELECT doc_id, list_sort(list(CAST(item_id AS VARCHAR))) AS items FROM exact GROUP BY doc_id
), held AS (
  SELECT doc_id, words, len(list_distinct(words)) AS of
  FROM (SELECT DISTINCT doc_id, unnest(w) AS word FROM d)
  JOIN (SELECT words, unnest(list_distinct(words)) AS word FROM (SELECT DISTINCT words FROM owners)) USING (word)
  GROUP BY doc_id, words HAVING 100 * count(*) >= 80 * len(list_distinct(words))
), runs AS (
  SELECT h.doc_id, h.words, h.of, d.w, unnest(range(0, greatest(len(d.w) - len(h.words) - 6, 0) + 1)) AS s
  FROM held h JOIN d ON d.doc_id = h.doc_id
), near AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near_items
  FROM (SELECT DISTINCT doc_id, item_id FROM runs JOIN owners USING (words)
        WHERE 100 * len(list_intersect(list_distinct(w[s + 1:s + len(words) + 6]), list_distinct(words))) >= 80 * of)
  WHERE (doc_id, item_id) NOT IN (SELECT (doc_id, item_id) FROM exact)
  GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN near USING (doc_id)
"""

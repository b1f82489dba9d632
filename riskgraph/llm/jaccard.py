"""N-gram Jaccard join as a blocked sparse matrix product.

The incidence matrix has a row per distinct shingle set ("set" below: all
documents with equal sets share one row) and a column per shingle.  Overlaps
are the off-diagonal entries of matrix x transpose.  It is never formed whole:

1. Blocks of columns (hash ranges) hold a fixed share of each row's lowest
   hashes.  A column with one row adds nothing off the diagonal, so a row
   whose shared columns in that share are fewer than its size-derived bound
   has no partner and leaves.
2. The rows left are gathered whole and bounded again by all their shared
   columns.
3. Columns are ordered rarest first.  A linked pair must meet in the first
   ``n - need + 1`` columns of both rows, and the columns left after the
   meeting must still be able to reach the required overlap.
4. In each column the most typical row is compared with all others (a star);
   linked rows form components.  Then only pairs of different components that
   meet under the bounds are compared, all of them.  Pairs inside a component
   cannot change it, so they are never made.

A row's size and its place in a column bound the sizes of its partners there.
Each column is split into bands of sizes, and a row only enters the bands that
its bounds reach, so rows that share a passage but cannot link do not meet.

Overlaps of candidate pairs are counted on whole sets; no candidate is capped.
Shingles are known by 64-bit hashes and sets by 63-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import discard, measured_side, prepare, ship, stored, table
from riskgraph.llm.components import components
from riskgraph.llm.textbytes import batch_bytes, doc_words, mix64, shingles

ship(__name__)

WIDTH = 5            # words in a shingle
THRESHOLD = 75       # per cent
BLOCK_ENTRIES = 500_000   # entries of the matrix in one column block
FLUSH_ENTRIES = 500_000   # entries a task holds before it emits its blocks
BAND = 1.05          # ratio of the set sizes at a size band's ends
SALT = 16            # parts of a large component when it takes its name


def required(n: np.ndarray | int, threshold: int) -> np.ndarray | int:
    """Least overlap of a set of ``n`` with any partner: ceil(t * n)."""
    return -(-n * threshold // 100)


def _set_id(h: np.ndarray) -> int:
    """63-bit id of a set from its sorted distinct hashes (never 0)."""
    if not len(h):
        return 0
    x = mix64(h + np.arange(len(h), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return int(mix64(np.array([x.sum(dtype=np.uint64) ^ np.uint64(len(h))]))[0] >> np.uint64(1)) | 1


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        data, offsets = batch_bytes(batch.column("text"))
        yield batch, [shingles(w, width) for _, w in doc_words(data, offsets)]


def _document_rows(width: int):
    def run(batches):
        for batch, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tk"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_set_id(s) for s in sets], pa.int64())], ["doc_id", "tk", "n_shingles", "set_id"])
    return run


def _lowest_share(n: int, threshold: int) -> int:
    """How many lowest hashes of a set of ``n`` enter the first product: the
    least that must meet (n - need + 1) and an eighth more."""
    return min(n, n - int(required(n, threshold)) + 1 + n // 8)


def _flush(sets: list[np.ndarray], ids: list[int], shift: int) -> pa.RecordBatch:
    """Block rows of a task's sets.  A column met twice here is known to be
    shared: its rows are counted at once and one marker entry (set 0) goes on,
    so no column has more entries in its block than there are flushes."""
    h = np.concatenate(sets)
    e = np.repeat(np.array(ids, np.int64), [len(s) for s in sets])
    order = np.lexsort((e, h))
    h, e = h[order], e[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (e[1:] != e[:-1])
    h, e = h[new], e[new]
    first = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=first[1:])
    count = np.diff(np.append(np.flatnonzero(first), len(h)))
    shared = np.repeat(count > 1, count)
    known, times = np.unique(e[shared], return_counts=True)
    e = np.where(shared, 0, e)[first]
    h = h[first]
    block = (h >> np.uint64(shift)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    ends = np.append(starts[1:], len(h))
    spread = np.arange(len(known)) % len(starts)  # the known counts ride along, dealt evenly
    return pa.RecordBatch.from_arrays([
        pa.array(block[starts], pa.int64()),
        pa.array([h[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
        pa.array([e[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
        pa.array([known[spread == k].tobytes() for k in range(len(starts))], pa.binary()),
        pa.array([times[spread == k].astype(np.int64).tobytes() for k in range(len(starts))], pa.binary()),
    ], ["block", "hashes", "sets", "known", "times"])


def _block_rows(width: int, threshold: int, shift: int):
    def run(batches):
        held, ids, size = [], [], 0
        for _, sets in _sets(batches, width):
            for s in sets:
                if len(s):
                    part = s[:_lowest_share(len(s), threshold)]
                    held.append(part)
                    ids.append(_set_id(s))
                    size += len(part)
                if size >= FLUSH_ENTRIES:
                    yield _flush(held, ids, shift)
                    held, ids, size = [], [], 0
        if held:
            yield _flush(held, ids, shift)
    return run


def _shared_counts(block: pa.Table) -> pa.Table:
    """Of one column block: how many shared columns each set has there."""
    def column(name, kind):
        return np.concatenate([np.frombuffer(x, kind) for x in block.column(name).to_pylist()])
    h, e = column("hashes", np.uint64), column("sets", np.int64)
    order = np.lexsort((e, h))
    h, e = h[order], e[order]
    start = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=start[1:])
    group = np.cumsum(start) - 1
    at = np.flatnonzero(start)
    last = np.append(at[1:], len(h)) - 1
    shared = (e[at] == 0) | (e[at] != e[last])  # marked, or two sets
    new = np.ones(len(h), bool)  # copies of one set in several tasks count once
    new[1:] = start[1:] | (e[1:] != e[:-1])
    hit = e[shared[group] & (e != 0) & new]
    ids, n = np.unique(np.concatenate([hit, np.repeat(column("known", np.int64), column("times", np.int64))]),
                       return_counts=True)
    return pa.table({"set_id": pa.array(ids, pa.int64()), "shared": pa.array(n, pa.int64())})


def _set_entries(width: int):
    def run(batches):
        for batch, sets in _sets(batches, width):
            ids = np.repeat(np.array([_set_id(s) for s in sets], np.int64), [len(s) for s in sets])
            h = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            for a in range(0, len(h), 1 << 18):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:a + (1 << 18)]), pa.array(h[a:a + (1 << 18)].view(np.int64))], ["set_id", "h"])
    return run


def _linked(pairs: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, by exact overlap."""
    left = rows.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("hs").alias("ha"))
    right = rows.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("hs").alias("hb"))
    overlap = F.size(F.array_intersect("ha", "hb"))
    return (pairs.join(left, "a").join(right, "b")
            .filter(F.lit(100) * overlap >= F.lit(threshold) * (F.col("na") + F.col("nb") - overlap))
            .select("a", "b"))


def _band(n: Column) -> Column:
    return F.floor(F.log(n) / float(np.log(BAND))).cast("int")


def _pairs(seekers: DataFrame, offers: DataFrame, threshold: int, unlike: str) -> DataFrame:
    """Distinct pairs (a, b) of rows that meet in a column under the size-derived
    bounds: ``seekers`` and ``offers`` are postings (h, set_id, n, pos, ...) that
    differ in the column ``unlike``.

    Two sets of sizes ``n >= m`` can link only if ``100 m >= t n``, and if they
    first meet at places ``p`` and ``q`` only if the columns left, at most
    ``min(n - p, m - q)``, reach ``t (n + m) / (100 + t)``.  So a posting names
    the sizes of its smaller partners: from ``t n / 100`` to the least of ``n``
    and ``(100 + t) (n - p) / t - n``.  Both directions are joined."""
    t = threshold
    low = F.ceil(F.col("n") * t / 100)
    high = F.least(F.col("n"), F.floor((F.col("n") - F.col("pos")) * (100 + t) / t) - F.col("n"))
    wide = seekers.withColumn("low", low).withColumn("high", high).filter("low <= high")
    x = wide.withColumn("band", F.explode(F.sequence(_band(F.col("low")), _band(F.col("high")))))
    y = offers.withColumn("band", _band(F.col("n")))
    left = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return (x.alias("x").join(y.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.band") == F.col("y.band")))
            .filter((F.col(f"x.{unlike}") != F.col(f"y.{unlike}")) & F.col("y.n").between(F.col("x.low"), F.col("x.high"))
                    & (F.lit(100 + t) * left >= F.lit(t) * (F.col("x.n") + F.col("y.n"))))
            .select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct())


def jaccard_components(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """Near-duplicate components of ``docs`` (doc_id, text; others ignored).

    Returns doc_id, n_shingles, component_id per input row; component_id is
    the smallest doc_id reachable by links of Jaccard >= threshold per cent.
    Null or wordless texts have an empty set, link with nothing and are their
    own component.  Repeated rows and copies share a set and a component.  A
    null doc_id is an ordinary row that never names a component.
    """
    return row_components(docs, width, threshold).select("doc_id", "n_shingles", "component_id")


def row_components(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """``jaccard_components`` with each row's text hash (tk) and the component's
    first row (keeper: unnamed, doc_id, tk), by doc_id, nulls last, then tk.
    Rows with an empty set have no keeper."""
    # Rows are named by doc_id, those without one by their text's hash.
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tk"))
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tk")
    ids = stored(texts.mapInArrow(_document_rows(width), "doc_id long, tk long, n_shingles long, set_id long"), "sets")
    total = ids.agg(F.sum("n_shingles")).first()[0] or 0
    if not total:
        return ids.select("doc_id", "tk", "n_shingles", F.col("doc_id").alias("component_id"),
                          F.when(F.lit(False), key).alias("keeper"))
    bits = max(0, int(np.ceil(np.log2(max(1, total * 3 / 8 / BLOCK_ENTRIES)))))
    bits = max(bits, 4)
    reps = ids.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.min("tk").alias("rep_tk"), F.first("n_shingles").alias("n"),
        F.min(key).alias("key"))

    # 1. Blocked product over the lowest hashes: rows with enough shared columns.
    counts = (texts.mapInArrow(_block_rows(width, threshold, 64 - bits),
                               "block long, hashes binary, sets binary, known binary, times binary")
              .groupBy("block").applyInArrow(_shared_counts, "set_id long, shared long")
              .groupBy("set_id").agg(F.sum("shared").alias("shared")))
    need = F.ceil(F.col("n") * threshold / 100)
    share = F.least("n", F.col("n") - need + 1 + F.expr("n div 8"))
    first = stored(counts.join(reps, "set_id").filter(F.col("shared") >= share - (F.col("n") - need))
                   .select("set_id", "rep", "rep_tk", "n"), "rows")

    # 2. Whole rows of what is left; shared columns with their row counts.
    chosen = measured_side(first.filter("rep is not null").select(F.col("rep").alias("doc_id")))
    unnamed = measured_side(first.filter("rep is null").select(F.col("rep_tk").alias("tk")))
    rows_of = texts.join(chosen, "doc_id", "left_semi").select("text").unionByName(
        texts.filter("doc_id is null").join(unnamed, "tk", "left_semi").select("text"))
    entries = stored(rows_of.mapInArrow(_set_entries(width), "set_id long, h long").distinct()
                     .join(measured_side(first.select("set_id", "n")), "set_id"), "entries")
    columns = entries.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    by_row = Window.partitionBy("set_id")
    shared = (entries.join(columns, "h")
              .withColumn("c", F.count("*").over(by_row))
              .filter(F.col("c") >= need)
              .withColumn("pos", F.col("n") - F.col("c")
                          + F.row_number().over(by_row.orderBy("df", "h")) - 1))
    shared = stored(shared, "shared")
    discard(entries)
    rows = stored(shared.groupBy("set_id", "n").agg(F.collect_list("h").alias("hs")), "whole")

    # 3. Postings of the columns in which a linked pair must meet first.
    postings = stored(shared.filter(F.col("pos") < F.col("n") - need + 1)
                      .select("h", "set_id", "n", "pos", "c"), "postings")
    discard(shared, first)

    # 4. Star in each column, then pairs of different components.
    centres = postings.groupBy("h").agg(
        F.max(F.struct((F.col("c") / F.col("n")).alias("typical"), F.col("set_id"), F.col("n"), F.col("pos"))).alias("m"))
    centres = stored(centres.select("h", "m.set_id", "m.n", "m.pos"), "centres")
    star = (_pairs(postings, centres, threshold, "set_id").unionByName(_pairs(centres, postings, threshold, "set_id"))
            .distinct())
    links = stored(_linked(star, rows, threshold), "links")
    labels = components(links)

    parted = postings.join(labels, postings["set_id"] == labels["id"], "left").select(
        "h", "set_id", "n", "pos", F.coalesce("label", "set_id").alias("label"))
    mixed = parted.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("h")
    parted = stored(parted.join(mixed, "h", "left_semi"), "parted")
    discard(postings, centres, labels)
    rest = _pairs(parted, parted, threshold, "label")
    more = _linked(rest, rows, threshold)
    joined = stored(links.unionByName(more), "links")
    discard(rows, links, parted)
    labels = components(joined)
    discard(joined)

    # A component is named by its smallest doc_id.  A set without links names
    # itself; a component's sets take its name in salted parts.
    linked = reps.join(labels.withColumnRenamed("id", "set_id"), "set_id").select(
        "set_id", "rep", "key", "label", F.pmod(F.xxhash64("set_id"), F.lit(SALT)).cast("int").alias("part"))
    least = (linked.groupBy("label").agg(F.min("rep").alias("component_id"), F.min("key").alias("keeper"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    named = (linked.join(least, ["label", "part"]).select("set_id", "component_id", "keeper")
             .unionByName(reps.join(labels, reps["set_id"] == labels["id"], "left_anti")
                          .select("set_id", F.col("rep").alias("component_id"), F.col("key").alias("keeper"))))
    return (ids.join(named, "set_id", "left")
            .select("doc_id", "tk", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "keeper"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def _rows_by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi- or anti-join of ``docs`` with stored keys (doc_id, tk), null ids included."""
    side = measured_side(keys.select(F.col("doc_id").alias("__id"), F.col("tk").alias("__tk")))
    return docs.join(side, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__tk")), how)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each component stays, that of the smallest
    doc_id (rows without one come last, then by text hash); rows with an empty
    set stay.  Rows are told apart by doc_id and text: other texts under the id
    of a row that goes stay, and copies without an id become one."""
    prepare(spark)
    found = stored(row_components(docs).filter("n_shingles > 0").withColumn(
        "keeps", F.col("keeper.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("keeper.tk") == F.col("tk")))
        .groupBy("doc_id", "tk", "keeps").count(), "found")
    gone = stored(found.filter("not keeps").select("doc_id", "tk"), "gone")
    twice = stored(found.filter("keeps and count > 1").select("doc_id", "tk"), "twice")
    kept = _rows_by_key(docs, gone, "left_anti")
    if twice.isEmpty():
        return kept
    return _rows_by_key(kept, twice, "left_anti").unionByName(
        _rows_by_key(kept, twice, "left_semi").dropDuplicates(["doc_id", "text"]))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT o.a, o.b FROM common o JOIN sizes x ON x.doc_id = o.a JOIN sizes y ON y.doc_id = o.b
  WHERE 100 * o.c >= 75 * (x.n + y.n - o.c)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, (SELECT min(r.b) FROM reach r WHERE r.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

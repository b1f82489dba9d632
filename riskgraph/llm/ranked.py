"""Ranked lexical search with bit-sliced Bloom signatures.

The index holds every document that has a term.  A document's signature is a
Bloom filter of its terms, each inserted once for every power of two that its
count reaches (1, 2, 4, ...), so the filter also bounds counts from above.
Documents of like size share a block, and a block is stored by slices: one
bitmap over its documents for every bit of the filter.  The documents that may
hold a term at a level are the AND of a few slices, never too few.

A search sums, per query term, the weights of these bitmaps: level by level
the largest score that a count below the next level could give in a document
of that length.  The sum is an upper bound of the document's score.  The
documents with the highest bounds are scored exactly first; the score of the
tenth is a floor, and every document whose bound reaches the floor is then
scored exactly from its text.  No document is excluded in any other way.

Queries go in passes of bounded size, each against all blocks.  The index also
holds the number of documents of every term (by the term, not a hash).
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from riskgraph.llm.common import discard, measured_side, prepare, ship, stored, table

ship(__name__)

TOP = 10
HASHES = 3               # slices read for a term at a level
BITS_PER_TERM = 10       # least bits of a signature for each insertion
BLOCK_DOCS = 256         # documents of a block
BLOCK_CELLS = 1 << 24    # bits of a block; larger signatures share it with fewer documents
TERMS_HELD = 300_000     # terms whose counts a task holds before it passes them on
PASS_QUERIES = 2_000     # queries and their text characters searched at once
PASS_CHARS = 4 << 20

# Fixed values of the contract.
SCALE, LENGTH_UNIT, FLAT, SLOPE = 1_000_000_000, 8, 10, 90

_SEPARATORS = [c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)]
_FOLD = bytes.maketrans(bytes([*_SEPARATORS, *range(65, 91)]), b" " * len(_SEPARATORS) + bytes(range(97, 123)))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)[:HASHES]
_LEVEL = 0xA0761D6478BD642F


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters and digits and of anything
    beyond ASCII, only A-Z lower-cased.  No byte of a longer character is an
    ASCII byte, so byte runs are character runs."""
    return text.translate(_FOLD).split() if text else []


def _slots(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    """(term, hash) slice numbers of terms at a level in a filter of 2^k bits."""
    at_level = h ^ np.uint64(level * _LEVEL % (1 << 64))
    return (at_level[:, None] * _FACTORS >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def _length_part(n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    return FLAT + SLOPE * n.astype(np.int64) * total_docs // total_terms


INDEX = T.StructType([
    T.StructField("bits", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("n", T.ArrayType(T.LongType())),
    T.StructField("slices", T.BinaryType()),
    T.StructField("term", T.BinaryType()),
    T.StructField("df", T.LongType()),
])


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the documents read, and counts of their terms."""
    waiting: dict[int, list] = {}
    df: Counter = Counter()

    def block(bits: int) -> pa.RecordBatch:
        docs = waiting.pop(bits)
        width = -(-len(docs) // 8) * 8
        cells = np.zeros((bits, width), np.uint8)
        for k, (_, _, slots) in enumerate(docs):
            cells[slots, k] = 1
        row = [[bits], [[d[0] for d in docs]], [[d[1] for d in docs]], [np.packbits(cells, axis=1).tobytes()], [None], [None]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names)

    def counts() -> pa.RecordBatch:
        k = len(df)
        cols = [pa.nulls(k, t) for t in kinds[:4]] + [pa.array(df.keys(), pa.binary()), pa.array(df.values(), pa.int64())]
        df.clear()
        return pa.RecordBatch.from_arrays(cols, names)

    names = INDEX.names
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64()]
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = Counter(terms(text))
            if not found:
                continue
            df.update(found.keys())
            h = np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))
            tf = np.fromiter(found.values(), np.int64, len(found))
            levels = int(tf.max()).bit_length()
            inserts = sum(int((tf >= 1 << j).sum()) for j in range(levels))
            bits = 1 << max(9, (BITS_PER_TERM * inserts - 1).bit_length())
            slots = np.unique(np.concatenate([_slots(h[tf >= 1 << j], j, bits).ravel() for j in range(levels)]))
            waiting.setdefault(bits, []).append((doc_id, int(tf.sum()), slots))
            if len(waiting[bits]) >= max(1, min(BLOCK_DOCS, BLOCK_CELLS // bits)):
                yield block(bits)
            if len(df) >= TERMS_HELD:
                yield counts()
    for bits in list(waiting):
        yield block(bits)
    if df:
        yield counts()


class Index:
    """Signature blocks and term counts of a corpus (stored tables)."""

    def __init__(self, docs: DataFrame):
        rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
        self.docs = rows
        self.raw = stored(rows.mapInArrow(_index_rows, INDEX), "signatures")
        self.blocks = self.raw.filter("bits is not null").select("bits", "doc_ids", "n", "slices")
        held = self.raw.filter("term is not null").select("term", "df")
        self.dictionary = stored(held.groupBy("term").agg(F.sum("df").alias("df")), "term-counts")
        self.n_docs, self.n_terms = (int(x or 0) for x in self.blocks.agg(
            F.sum(F.size("n")), F.sum(F.expr("aggregate(n, 0L, (a, x) -> a + x)"))).first())

    def discard(self) -> None:
        discard(self.raw, self.dictionary)


def _weights(index: Index, wanted: set[bytes]) -> dict[bytes, int]:
    """Weights of the terms of one pass that some document holds."""
    spark = index.dictionary.sparkSession
    asked = spark.createDataFrame([(t,) for t in wanted], "term binary")
    found = index.dictionary.join(F.broadcast(asked), "term").collect()
    return {bytes(r["term"]): math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * r["df"] + 1))) for r in found}


def _pairs(queries: list[dict[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, hash, weight) of every query term that can score, by query."""
    flat = [(q, xxh64_intdigest(t), w) for q, ws in enumerate(queries) for t, w in ws.items() if w > 0]
    q, h, w = zip(*flat, strict=True) if flat else ((), (), ())
    return np.array(q, np.int64), np.array(h, np.uint64), np.array(w, np.int64)


def _bounds(bits: int, n: np.ndarray, slices: bytes, pairs, n_queries: int, n_docs: int, n_terms: int,
            step: int = 2048) -> np.ndarray:
    """(query, document) upper bounds of one block."""
    q, h, w = pairs
    docs = len(n)
    rows = np.frombuffer(slices, np.uint8).reshape(bits, -1)
    m = _length_part(n, n_docs, n_terms)
    most = []  # largest count part below the next level, level by level
    while not most or (1 << len(most)) <= int(n.max()):
        tf = np.minimum((2 << len(most)) - 1, n)
        most.append(SCALE * tf // (1000 * tf + LENGTH_UNIT * m))
    out = np.zeros((n_queries, docs), np.int64)
    for a in range(0, len(q), step):
        hs, qs, ws = h[a:a + step], q[a:a + step], w[a:a + step]
        part = np.zeros((len(hs), docs), np.int64)
        here, alive = np.arange(len(hs)), None
        for level, bound in enumerate(most):
            got = np.bitwise_and.reduce(rows[_slots(hs[here], level, bits)], axis=1)
            alive = got if alive is None else alive & got
            left = alive.any(axis=1)
            here, alive = here[left], alive[left]
            if not len(here):
                break
            more = bound - (most[level - 1] if level else 0)
            part[here] += np.unpackbits(alive, axis=1, count=docs) * more
        part *= ws[:, None]
        first = np.flatnonzero(np.concatenate([[True], qs[1:] != qs[:-1]]))
        out[qs[first]] += np.add.reduceat(part, first, axis=0)
    return out


def _blocks_of(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for k in range(batch.num_rows):
            yield (batch.column("bits")[k].as_py(), batch.column("doc_ids")[k].as_py(),
                   batch.column("n")[k].values.to_numpy(zero_copy_only=False), batch.column("slices")[k].as_py())


_FOUND = pa.schema([("q", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_FOUND.names, r, strict=True)) for r in rows], _FOUND)


def _best_bounds(pairs, n_queries: int, n_docs: int, n_terms: int, top: int):
    """Per task and query the documents of the highest bounds."""
    def run(batches):
        best: list[list] = [[] for _ in range(n_queries)]
        for bits, ids, n, slices in _blocks_of(batches):
            ub = _bounds(bits, n, slices, pairs, n_queries, n_docs, n_terms)
            k = min(top, ub.shape[1])
            at = np.argpartition(-ub, k - 1, axis=1)[:, :k]
            for q in range(n_queries):
                got = [(int(ub[q, d]), -1 if ids[d] is None else 0, ids[d] or 0) for d in at[q].tolist() if ub[q, d] > 0]
                if got:
                    best[q] = heapq.nlargest(top, best[q] + got)
        yield _found([(q, None if null else i, s) for q in range(n_queries) for s, null, i in best[q]])
    return run


def _reaching(pairs, floors: np.ndarray, n_docs: int, n_terms: int):
    """Every (query, document) whose bound reaches the query's floor."""
    def run(batches):
        for bits, ids, n, slices in _blocks_of(batches):
            ub = _bounds(bits, n, slices, pairs, len(floors), n_docs, n_terms)
            q, d = np.nonzero(ub >= floors[:, None])
            if len(q):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(ids, pa.int64()).take(pa.array(d)), pa.array(ub[q, d])], _FOUND.names)
    return run


def _exact(queries: list[dict[bytes, int]], n_docs: int, n_terms: int, top: int):
    """Per task and query the best exact scores of the texts read; equal
    scores by ascending doc_id, rows without one last."""
    def run(batches):
        best: list[list] = [[] for _ in queries]
        for batch in batches:
            for doc_id, text, asked in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "queries")), strict=True):
                found = Counter(terms(text))
                n = sum(found.values())
                if not n:
                    continue
                m = FLAT + SLOPE * n * n_docs // n_terms
                for q in asked:
                    ws = queries[q]
                    score = sum(w * (SCALE * found[t] // (1000 * found[t] + LENGTH_UNIT * m)) for t, w in ws.items() if t in found)
                    if score > 0:
                        entry = (score, doc_id is not None, -(doc_id or 0))
                        if len(best[q]) < top:
                            heapq.heappush(best[q], entry)
                        elif entry > best[q][0]:
                            heapq.heapreplace(best[q], entry)
        yield _found([(q, -i if known else None, s) for q, rows in enumerate(best) for s, known, i in rows])
    return run


_SCHEMA = "q long, doc_id long, score long"


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best rows of each query; tasks pass on at most as many."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _score(index: Index, asked: DataFrame, queries, top: int) -> DataFrame:
    """Exact scores (stored) of the candidates (q, doc_id): all rows of each
    candidate doc_id are read, rows without one for the null candidate."""
    by_doc = stored(asked.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("q").alias("queries")), "candidates")
    docs = index.docs.join(measured_side(by_doc), F.col("doc_id").eqNullSafe(F.col("id")))
    scored = docs.select("doc_id", "text", "queries").mapInArrow(_exact(queries, index.n_docs, index.n_terms, top), _SCHEMA)
    out = stored(_ranked(scored, top), "scored")
    discard(by_doc)
    return out


def _search_pass(index: Index, items: list[tuple], schema: T.StructType, top: int) -> DataFrame:
    """Ranked rows (item_id, rank, doc_id, score) of one pass (stored)."""
    spark = index.blocks.sparkSession
    words = [set(terms(text)) for _, text in items]
    weights = _weights(index, set().union(*words))
    queries = [{t: weights[t] for t in ws if weights.get(t, 0) > 0} for ws in words]
    pairs, size = _pairs(queries), (index.n_docs, index.n_terms)

    bounds = index.blocks.mapInArrow(_best_bounds(pairs, len(queries), *size, top), _SCHEMA)
    seeds = stored(_ranked(bounds, top), "seeds")
    first = _score(index, seeds, queries, top)
    floors = np.ones(len(queries), np.int64)
    for r in first.filter(F.col("rank") == top).collect():
        floors[r["q"]] = r["score"]

    reaching = index.blocks.mapInArrow(_reaching(pairs, floors, *size), _SCHEMA)
    last = _score(index, reaching, queries, top)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)],
                                  T.StructType([T.StructField("q", T.LongType()), schema["item_id"]]))
    out = stored(last.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"), "ranked")
    discard(seeds, first, last)
    return out


def _passes(items: DataFrame) -> Iterator[list[tuple]]:
    """Items in lists of bounded number and size; an outsized item has its own."""
    held, chars = [], 0
    for row in items.toLocalIterator():
        text = bytes(row["text"] or b"")
        if held and (len(held) >= PASS_QUERIES or chars + len(text) > PASS_CHARS):
            yield held
            held, chars = [], 0
        held.append((row["item_id"], text))
        chars += len(text)
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` highest-scoring rows of ``docs`` (doc_id, text) for each row
    of ``items`` (item_id, text): item_id, rank, doc_id, score.

    Each row of ``docs`` is a document of its own, repeated rows and rows
    without a doc_id included (the latter come last among equal scores, with a
    null doc_id).  Null and empty texts hold no term and are not counted.  An
    item without a term that some document holds has no rows; repeated items
    repeat theirs.  Empty tables give no rows.
    """
    index = Index(docs)
    queries = items.select("item_id", F.col("text").cast("binary").alias("text"))
    found = [_search_pass(index, held, items.schema, top) for held in _passes(queries)] if index.n_docs else []
    index.discard()
    if not found:
        kind = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()),
                             T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], kind)
    return reduce(DataFrame.unionByName, found)


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS t, len(w) AS n FROM d),
c AS (SELECT doc_id, t, n, count(*) AS tf FROM t GROUP BY ALL),
size AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT t, count(*) AS df FROM c GROUP BY t), size
), asked AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS t FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN c USING (t) JOIN weight USING (t), size GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

"""Hard-negative mining with length buckets and coordinate pruning.

Rows are put into buckets of like length (norm), and a bucket into blocks of a
few thousand rows, each with a sorted list of every coordinate.  For an anchor
``a`` and a score floor ``s``, a row of length at most ``l`` reaches the floor
only if its angle to ``a`` is at most ``acos(s / (|a| l))``; a block whose
ratio is over 1 is left at once.  Else the angle bounds the row's value in each
coordinate.  For the anchor's focus coordinates (its largest ones) the feasible
range is cut from the block's sorted list, the lists are intersected, and only
the rows left are scored, exactly.

An anchor's floor starts from its best rows in a bounded set of seed blocks
and rises with the best rows that a task has found so far.  A floor is always
the score of some row set that is at least as good, so nothing is lost.

Anchors go in passes of bounded size, each against all blocks; a task keeps a
few best rows an anchor, and a window over tasks picks the last ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import discard, prepare, ship, stored, table

ship(__name__)

EVERY = 100            # anchors are rows whose vec_id this number divides
POSITIVES, NEGATIVES = 5, 5
SHARE = (80, 100)      # per cent of the positive's score that a negative has, least and most
BUCKET_STEP = 1.1      # ratio of the lengths at a bucket's ends
BLOCK_ROWS = 4096
FOCUS = 3              # coordinates whose ranges are intersected
PASS_ANCHORS = 4096
ANCHORS_AT_ONCE = 256  # anchors scored together against a block
LONGEST = 2.0 ** 31    # scores of rows this long would not fit 64 bits
EXACT = 2.0 ** 52      # products of lengths below it are exact in doubles

BLOCK = ("bucket int, longest double, dims int, uids array<long>, ids array<long>, labels array<long>, "
         "matrix binary, lists binary")


def prepared(rows: DataFrame) -> DataFrame:
    """(uid, vec_id, label, v, norm) of the rows that take part (stored): v
    holds the integer components, uid tells repeated rows apart."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    v = rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform(x, lambda c: F.floor(256 * c)).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    v = v.withColumn("norm", norm).filter(F.col("norm") < LONGEST)
    return stored(v.select(F.monotonically_increasing_id().alias("uid"), "*"), "vectors")


def _matrix(column, dims: int) -> np.ndarray:
    """(rows, dims) integers of an array column; missing components are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    out = np.zeros((len(lengths), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _block(rows: pa.Table) -> pa.Table:
    """One block of a bucket with its sorted coordinate lists."""
    lengths = rows.column("v").combine_chunks().value_lengths()
    dims = max(lengths.to_pylist(), default=0)
    m = _matrix(rows.column("v"), dims)
    lists = np.argsort(m, axis=0, kind="stable").T.astype(np.int32)
    cells = [[rows.column("bucket")[0].as_py()], [max(rows.column("norm").to_pylist())], [dims],
             *[[rows.column(c).to_pylist()] for c in ("uid", "vec_id", "label")], [m.tobytes()], [lists.tobytes()]]
    kinds = [pa.int32(), pa.float64(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.binary(), pa.binary()]
    names = ["bucket", "longest", "dims", "uids", "ids", "labels", "matrix", "lists"]
    return pa.table([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=names)


def blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of about ``BLOCK_ROWS`` rows of like length (stored), with the
    number ``part`` of the block in its bucket.  Rows are dealt by a hash of
    their uid, so equal vectors spread."""
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / float(np.log(BUCKET_STEP)))).otherwise(-1000).cast("int")
    rows = vectors.withColumn("bucket", bucket)
    parts = rows.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("parts"))
    dealt = (rows.join(F.broadcast(parts), "bucket")  # a few hundred buckets at most, as lengths are bounded
             .withColumn("part", F.pmod(F.xxhash64("uid"), "parts")))
    made = dealt.groupBy("bucket", "part").applyInArrow(lambda key, t: _block(t).append_column(
        "part", pa.array([key[1].as_py()], pa.int64())), BLOCK + ", part long")
    return stored(made, "blocks")


class Anchors:
    """The anchors of one pass, as arrays."""

    def __init__(self, rows: pa.Table):
        self.uids = rows.column("uid").to_numpy()
        self.ids = rows.column("vec_id").to_numpy()
        self.labels = rows.column("label").to_numpy()
        self.norms = rows.column("norm").to_numpy()
        dims = max(rows.column("v").combine_chunks().value_lengths().to_pylist(), default=0)
        self.m = _matrix(rows.column("v"), dims)
        self.focus = np.argsort(-np.abs(self.m), axis=1, kind="stable")[:, :FOCUS]


def feasible(block: dict, anchors: Anchors, some: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """(anchor, row) mask of the rows of a block that may reach the floors of
    the anchors ``some``: bucket bound, then ranges of focus coordinates."""
    n, longest = len(block["uids"]), block["longest"]
    out = np.zeros((len(some), n), bool)
    for k, a in enumerate(some.tolist()):
        reach = anchors.norms[a] * longest
        if floors[k] > reach * (1 + 1e-9):
            continue
        if reach == 0:
            out[k] = True
            continue
        angle = np.arccos(np.clip(floors[k] / reach - 1e-9, -1, 1))
        meets, counted = np.zeros(n, np.int8), 0
        for f in anchors.focus[a].tolist():
            if f >= block["dims"]:
                continue
            own = np.arccos(np.clip(anchors.m[a, f] / anchors.norms[a], -1, 1))
            low = longest * (np.cos(min(np.pi, own + angle)) - 1e-6)
            high = longest * (np.cos(max(0.0, own - angle)) + 1e-6)
            i, j = np.searchsorted(block["sorted"][f], low), np.searchsorted(block["sorted"][f], high, "right")
            if j - i < n:
                meets[block["lists"][f, i:j]] += 1
                counted += 1
        out[k] = meets == counted
    return out


def _scores(block: dict, anchors: Anchors, some: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products (anchor, row); missing components are 0."""
    d = min(block["dims"], anchors.m.shape[1])
    kind = np.float64 if anchors.norms[some].max(initial=0) * block["longest"] < EXACT else object
    return (anchors.m[some, :d].astype(kind) @ block["m"][rows, :d].astype(kind).T).astype(np.int64)


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in batch.to_pylist():
            n, dims = len(row["uids"]), row["dims"]
            m = np.frombuffer(row["matrix"], np.int64).reshape(n, dims)
            lists = np.frombuffer(row["lists"], np.int32).reshape(dims, n)
            yield {"uids": np.array(row["uids"], np.int64), "labels": np.array(row["labels"], np.int64),
                   "ids": np.array([0 if i is None else i for i in row["ids"]], np.int64),
                   "named": np.array([i is not None for i in row["ids"]], bool), "longest": row["longest"], "dims": dims,
                   "m": m, "lists": lists, "sorted": np.take_along_axis(m.T, lists, axis=1) if dims else m.T}


class Best:
    """The best ``top`` rows of each slot: higher scores first, then smaller
    vec_ids, rows without one last."""

    def __init__(self, floors: np.ndarray, top: int):
        self.rows: list[list[tuple]] = [[] for _ in floors]
        self.floors, self.top = floors.astype(np.float64), top

    def take(self, slot: int, scores: np.ndarray, at: np.ndarray, block: dict) -> None:
        """Rows ``at`` of the block, all at or over the slot's floor."""
        if len(at) > self.top:
            cut = np.partition(scores, len(at) - self.top)[len(at) - self.top]
            at, scores = at[scores >= cut], scores[scores >= cut]
            order = np.lexsort((block["ids"][at], ~block["named"][at], -scores))[:self.top]
            at, scores = at[order], scores[order]
        new = [(int(s), bool(block["named"][r]), -int(block["ids"][r])) for s, r in zip(scores, at, strict=True)]
        if new:
            self.rows[slot] = heapq.nlargest(self.top, self.rows[slot] + new)
            if len(self.rows[slot]) == self.top:
                self.floors[slot] = max(self.floors[slot], self.rows[slot][-1][0])

    def batch(self, names: list[tuple]) -> pa.RecordBatch:
        flat = [(*names[k], -i if named else None, s) for k, rows in enumerate(self.rows) for s, named, i in rows]
        return pa.RecordBatch.from_pylist([dict(zip(_BEST.names, r, strict=True)) for r in flat], _BEST)


_BEST = pa.schema([("uid", pa.int64()), ("nth", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_BEST_SQL = "uid long, nth long, vec_id long, score long"


def _groups(anchors: Anchors) -> list[np.ndarray]:
    return np.array_split(np.arange(len(anchors.uids)), -(-len(anchors.uids) // ANCHORS_AT_ONCE))


def _same_label(anchors: Anchors, floors: np.ndarray, top: int):
    """Best other rows of each anchor's label, per task."""
    def run(batches):
        best = Best(floors, top)
        for block in _read_blocks(batches):
            for some in _groups(anchors):
                mask = feasible(block, anchors, some, best.floors[some])
                mask &= (anchors.labels[some, None] == block["labels"]) & (anchors.uids[some, None] != block["uids"])
                rows = np.flatnonzero(mask.any(axis=0))
                if len(rows):
                    scores = _scores(block, anchors, some, rows)
                    for k, a in enumerate(some.tolist()):
                        at = np.flatnonzero(mask[k, rows] & (scores[k] >= best.floors[a]))
                        best.take(a, scores[k, at], rows[at], block)
        yield best.batch([(int(u), 0) for u in anchors.uids])
    return run


def _other_label(anchors: Anchors, owner: np.ndarray, nth: np.ndarray, ceiling: np.ndarray, share: tuple[int, int], top: int):
    """Best rows of other labels for each (anchor, positive), whose score is
    ``ceiling``; ``owner`` is the anchor of each, ascending."""
    def run(batches):
        low, high = (-(-share[0] * ceiling // 100), share[1] * ceiling // 100)
        best = Best(low, top)
        slots = {a: np.flatnonzero(owner == a).tolist() for a in set(owner.tolist())}
        for block in _read_blocks(batches):
            for some in _groups(anchors):
                some = np.array([a for a in some.tolist() if a in slots], np.int64)
                floors = np.array([min(best.floors[s] for s in slots[a]) for a in some.tolist()])
                mask = feasible(block, anchors, some, floors)
                mask &= anchors.labels[some, None] != block["labels"]
                rows = np.flatnonzero(mask.any(axis=0))
                if len(rows):
                    scores = _scores(block, anchors, some, rows)
                    for k, a in enumerate(some.tolist()):
                        for s in slots[a]:
                            at = np.flatnonzero(mask[k, rows] & (scores[k] >= best.floors[s]) & (scores[k] <= high[s]))
                            best.take(s, scores[k, at], rows[at], block)
        yield best.batch([(int(anchors.uids[a]), int(n)) for a, n in zip(owner, nth, strict=True)])
    return run


def _first(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("uid", "nth").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _mine_pass(made: DataFrame, anchors: Anchors, positives: int, negatives: int, share: tuple[int, int]) -> DataFrame | None:
    """The triples of one pass (stored), or None if there are none."""
    spark, place = made.sparkSession, {u: k for k, u in enumerate(anchors.uids.tolist())}
    columns = made.select("longest", "dims", "uids", "ids", "labels", "matrix", "lists", "part")

    def same(rows: DataFrame, floors: np.ndarray) -> DataFrame:
        return stored(_first(rows.drop("part").mapInArrow(_same_label(anchors, floors, positives), _BEST_SQL), positives), "positives")

    floors = np.full(len(anchors.uids), -np.inf)
    seeds = same(columns.filter("part = 0"), floors)
    for r in seeds.filter(F.col("rank") == positives).collect():
        floors[place[r["uid"]]] = r["score"]
    found = same(columns, floors)
    # A positive below 0 has no score between its share and itself.
    rows = sorted((place[r["uid"]], r["rank"], r["score"], r["vec_id"]) for r in found.filter("score >= 0").collect())
    discard(seeds, found)
    if not rows:
        return None
    owner, nth, ceiling = (np.array([r[k] for r in rows], np.int64) for k in range(3))
    mined = columns.drop("part").mapInArrow(_other_label(anchors, owner, nth, ceiling, share, negatives), _BEST_SQL)
    pairs = spark.createDataFrame(
        [(int(anchors.uids[a]), int(n), int(anchors.ids[a]), p, int(s)) for a, n, s, p in rows],
        "uid long, nth long, anchor_id long, positive_id long, positive_score long")
    out = _first(mined, negatives).join(F.broadcast(pairs), ["uid", "nth"])  # at most PASS_ANCHORS * positives rows
    return stored(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                             F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "mined")


def hard_negatives(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   share: tuple[int, int] = SHARE) -> DataFrame:
    """Hard negatives of the anchors in ``rows`` (vec_id, embedding, label):
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label, a null vector or a null or non-finite component
    take no part, nor do rows so long (2^31 in integer units) that scores
    would not fit 64 bits.  Vectors of unequal length are compared as if the
    shorter one went on with zeros.  Every row is a row of its own: repeated
    rows are positives of each other, a repeated anchor repeats its triples.
    Rows without a vec_id are never anchors and come last among equal scores.
    Anchors without a positive, and positives without a negative, have no
    rows; neither has an empty table.
    """
    vectors = prepared(rows.select("vec_id", "embedding", "label"))
    made = blocks(vectors)
    anchors = vectors.filter(F.col("vec_id") % every == 0)
    passes = -(-anchors.count() // PASS_ANCHORS)
    mined = []
    for p in range(passes):
        held = anchors.filter(F.pmod(F.xxhash64("uid"), F.lit(passes)) == p).toArrow()
        if held.num_rows:
            mined.append(_mine_pass(made, Anchors(held), positives, negatives, share))
    discard(made, vectors)
    mined = [m for m in mined if m is not None]
    if not mined:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                     "positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, mined)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return hard_negatives(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""

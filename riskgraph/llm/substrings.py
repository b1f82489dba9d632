"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: every byte shifts the hash
left by one bit and adds the byte's gear value, so a 16-bit hash depends on
the last 16 bytes only.  A cut falls before a byte where the hash has
``BITS`` zero bits on top, unless another such place lies within ``LEAST``
bytes before it; cuts depend on nearby bytes only and come back into step soon
after an insertion.

A window is the fewest chunks from a cut on that reach the least span.  Windows
are deduplicated by digest across documents, and each repeated one is paired
with one place in the smallest other document that holds it.  Windows that meet
that document at one distance form a run; a run is compared with that document
by a second hash and extended to where the two texts differ.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import prepare, ship, stored, table
from riskgraph.llm.textbytes import batch_bytes, mix64

ship(__name__)

REACH = 16          # bytes a hash depends on (the width of the hash)
BITS = 4            # zero bits of a cut: one place in 16
LEAST = 8           # bytes between a cut and the next possible one
MOST = 4096         # a chunk without a cut is divided at this many bytes
SPAN_LEAST = 80     # code points a repeated span needs to be reported
PIECE = 1 << 20     # bytes rolled at once
BESIDE = 32         # code points read beyond the chunk beside a run: more than a cut depends on
FIELD = 17          # bits of a length in a window's shape

# The gear: one 16-bit value per byte, from a rule.
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash after each byte, by doubling: the hash of the last 2k
    bytes is that of the last k plus the one k bytes earlier, shifted by k."""
    h = GEAR[data]
    k = 1
    while k < REACH:
        h[k:] = h[k:] + (h[:-k] << np.uint16(k))
        k *= 2
    return h


def cuts(data: np.ndarray) -> np.ndarray:
    """Places (0 < place < len) before which a chunk ends, ascending."""
    found = []
    for a in range(0, max(1, len(data)), PIECE):
        lo = max(0, a - REACH + 1)
        h = gear_hashes(data[lo:a + PIECE])[a - lo:]
        at = np.flatnonzero(h >> np.uint16(16 - BITS) == 0) + a + 1
        found.append(at)
    at = np.concatenate(found)
    at = at[(at >= REACH) & (at < len(data))]
    at = at[(data[at] & 0xC0) != 0x80] if len(at) else at  # never inside a character
    if len(at) > 1:
        at = at[np.concatenate([[True], np.diff(at) > LEAST])]
    edges = np.concatenate([[0], at, [len(data)]])
    long = np.flatnonzero(np.diff(edges) > MOST)
    if len(long):
        more = []
        for k in long:
            x = np.arange(edges[k] + MOST, edges[k + 1], MOST)
            while ((data[x] & 0xC0) == 0x80).any():
                x = x - ((data[x] & 0xC0) == 0x80)
            more.append(x)
        at = np.unique(np.concatenate([at, *more]))
    return at


def chunks(text: bytes) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of each chunk of a text, in bytes."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return []
    edges = [0, *cuts(data).tolist(), len(data)]
    return [(a, b, xxhash.xxh3_128_digest(text[a:b])) for a, b in zip(edges, edges[1:])]  # noqa: B905


def _windows(text: bytes, edges: np.ndarray, points: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(place, shape, digest) of each window of a text.  place is the window's
    start in code points and its first chunk's number; shape is its length, the
    lengths of the chunk before it and of what the next window adds, and its
    number of chunks."""
    m = len(edges) - 1
    to = np.searchsorted(points, points[:-1] + least)
    i = np.flatnonzero(to <= m)
    j = to[i]
    more = np.minimum(np.append(to, m + 1)[i + 1], m)
    before = points[i] - points[np.maximum(i - 1, 0)]
    shape = ((((points[j] - points[i]) << FIELD | before) << FIELD) | (points[more] - points[j])) << 12 | (j - i)
    digests = [xxhash.xxh3_64_intdigest(text[p:q]) for p, q in zip(edges[i].tolist(), edges[j].tolist(), strict=True)]
    return points[i] << 32 | i, shape, digests


def _window_rows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = batch_bytes(batch.column("text"))
            a = 0
            while a < batch.num_rows:  # a few MB of text at a time
                z = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PIECE, "right")) - 1)
                rows, places, shapes, digests = [], [], [], []
                for i in range(a, z):
                    raw = data[offsets[i]:offsets[i + 1]]
                    if not len(raw):
                        continue
                    edges = np.concatenate([[0], cuts(raw), [len(raw)]])
                    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[edges]  # in code points
                    place, shape, found = _windows(raw.tobytes(), edges, points, least)
                    rows.append(np.full(len(place), i))
                    places.append(place)
                    shapes.append(shape)
                    digests.extend(found)
                if rows:
                    row = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(row), batch.column("tk").take(row),
                         pa.array(np.concatenate(places).astype(np.int64)), pa.array(np.concatenate(shapes).astype(np.int64)),
                         pa.array(np.array(digests, np.uint64).view(np.int64))], ["doc_id", "tk", "place", "shape", "h"])
                a = z
    return run


def _numbered(docs: DataFrame) -> tuple[DataFrame, int | None]:
    """Rows (doc_id, text) where those without a doc_id are numbered by their
    text beyond the greatest one, and that greatest one (None: all have one)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("text is not null")
    if rows.filter("doc_id is null").isEmpty():
        return rows, None
    most = rows.agg(F.max("doc_id")).first()[0] or 0
    number = F.lit(most + 1) + F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1))
    return rows.withColumn("doc_id", F.coalesce("doc_id", number)), most


def _named(docs: DataFrame) -> DataFrame:
    """Rows with a name; tk tells apart the texts that share one."""
    return docs.select(F.col("doc_id").cast("long"), F.hash("text").alias("tk"), "text").filter("doc_id is not null and text is not null")


def window_table(docs: DataFrame, least: int = SPAN_LEAST) -> DataFrame:
    """Window rows (doc_id, tk, place, shape, h).  Null texts and those under
    ``least`` code points have none.  Rows need a doc_id here."""
    return _named(docs).mapInArrow(_window_rows(least), "doc_id long, tk int, place long, shape long, h long")


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs extended by what the texts beside them have in common."""
    def common(x: str, y: str) -> int:
        return len(os.path.commonprefix([x, y]))
    for batch in batches:
        c = {name: batch.column(name).to_pylist() for name in ("before", "other_before", "after", "other_after")}
        left = [common(x[::-1], y[::-1]) for x, y in zip(c["before"], c["other_before"], strict=True)]
        right = [common(x, y) for x, y in zip(c["after"], c["other_after"], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tk"),
             pa.array(np.asarray(batch.column("start")) - np.array(left, np.int64)),
             pa.array(np.asarray(batch.column("end")) + np.array(right, np.int64)), batch.column("n_chunks"), batch.column("other")],
            ["doc_id", "tk", "start", "end", "n_chunks", "other"])


RUN = ["doc_id", "tk", "other", "other_tk", "shift"]


def _placed(rows: DataFrame) -> DataFrame:
    """Window rows that another document holds too, each with the place
    ``shift`` further on in the smallest other document that has it.  Rows meet
    by digest in one exchange, which leaves out the windows of one document,
    and by document in the next."""
    same = Window.partitionBy("h")
    rows = (rows.withColumn("first", F.min("doc_id").over(same)).withColumn("last", F.max("doc_id").over(same))
            .filter("first < last"))
    # One place of the window in its smallest and in its largest document.
    least = {d: F.min(F.when(F.col("doc_id") == F.col(d), F.struct("tk", "place"))).over(same) for d in ("first", "last")}
    rows = rows.withColumn("in_first", least["first"]).withColumn("in_last", least["last"])
    rows = rows.withColumn("o", F.expr("if(doc_id = first, in_last, in_first)"))
    return rows.select("doc_id", "tk", F.expr("if(doc_id = first, last, first)").alias("other"), F.col("o.tk").alias("other_tk"),
                       (F.shiftright("o.place", 32) - F.shiftright("place", 32)).alias("shift"), "place", "shape").repartition(*RUN)


def _runs(rows: DataFrame) -> DataFrame:
    """Stored runs (doc_id, tk, other, other_tk, shift, start, end, n_chunks,
    before_room, behind_room): code points [start, end) of a text stand in
    ``other``, ``shift`` further on.  The rooms are how far beside the run the
    texts are still compared."""
    mask = (1 << FIELD) - 1
    placed = (_placed(rows)
              .select(*RUN, F.shiftright("place", 32).alias("start"),
                      F.col("place").bitwiseAND(0xFFFFFFFF).alias("chunk"),
                      F.shiftright("shape", 12 + 2 * FIELD).alias("size"),
                      F.shiftright("shape", 12 + FIELD).bitwiseAND(mask).alias("before"),
                      F.shiftright("shape", 12).bitwiseAND(mask).alias("behind"),
                      F.col("shape").bitwiseAND(0xFFF).alias("k"))
              .withColumn("end", F.col("start") + F.col("size")))
    ordered = Window.partitionBy(*RUN).orderBy("start")
    upto = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("fresh", (F.col("start") > F.coalesce(upto, F.lit(-1))).cast("int"))
    placed = placed.withColumn("run", F.sum("fresh").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    runs = (placed.groupBy(*RUN, "run").agg(
                F.min("start").alias("start"), F.max("end").alias("end"),
                (F.max(F.col("chunk") + F.col("k")) - F.min("chunk")).alias("n_chunks"),
                F.min(F.struct("start", "before"))["before"].alias("before_room"),
                F.max(F.struct("end", "behind"))["behind"].alias("behind_room"))
            .withColumn("before_room", F.least(F.col("before_room") + BESIDE, "start", F.col("start") + F.col("shift")))
            .withColumn("behind_room", F.col("behind_room") + BESIDE).drop("run"))
    return stored(runs, "runs")


def _beside(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``runs`` with the texts beside them in both documents, where a hash of
    the run's own text agrees.  A run asks for both at once, so the texts move
    once; they do at every size (a merge join), as the runs grow with them."""
    named = _named(docs).select(F.col("doc_id").alias("__d"), F.col("tk").alias("__t"), "text")
    asked = runs.withColumn("ask", F.explode(F.array(
        F.struct(F.col("doc_id").alias("d"), F.col("tk").alias("t"), F.lit(0).cast("long").alias("by"), F.lit(False).alias("far")),
        F.struct(F.col("other").alias("d"), F.col("other_tk").alias("t"), F.col("shift").alias("by"), F.lit(True).alias("far")))))
    asked = asked.select(*runs.columns, "ask.*").hint("merge")
    found = named.join(asked, (F.col("__d") == F.col("d")) & (F.col("__t") == F.col("t"))).select(
        *runs.columns, "far", F.struct(
            F.expr("substring(text, int(start + by - before_room) + 1, int(before_room))").alias("before"),
            F.expr("substring(text, int(end + by) + 1, int(behind_room))").alias("after"),
            F.expr("xxhash64(substring(text, int(start + by) + 1, int(end - start)))").alias("same")).alias("piece"))
    # Rows that are equal, or share a name by chance, make more than one piece.
    both = found.groupBy(*runs.columns).agg(F.collect_set(F.when(~F.col("far"), F.col("piece"))).alias("here"),
                                            F.collect_set(F.when(F.col("far"), F.col("piece"))).alias("there"))
    both = both.withColumn("here", F.explode("here")).withColumn("there", F.explode("there")).filter("here.same = there.same")
    return both.select(*runs.columns, "here.before", "here.after", F.col("there.before").alias("other_before"),
                       F.col("there.after").alias("other_after"))


def repeated_spans(docs: DataFrame, least: int = SPAN_LEAST) -> DataFrame:
    """Spans of ``docs`` (doc_id, text) that another document holds whole.

    Returns doc_id, start, end (code points, end exclusive), n_chunks (whole
    chunks found in both), first_doc_id (smallest doc_id that holds the span)
    and duplicate (whether that is another document, so this copy is the one
    to cut).  A span ends where the two texts differ, as far as the next
    window; spans of one document with different holders may overlap, and one
    inside another is left out.  Spans have at least ``least`` code points.
    Repeats inside one document alone are not reported; rows that share a
    doc_id count as one document, and so do rows without one that share their
    text: these come after all others and have a null doc_id in the result.
    """
    docs, most = _numbered(docs)
    both = _beside(docs, _runs(window_table(docs, least)))
    spans = both.mapInArrow(_extended, "doc_id long, tk int, start long, end long, n_chunks long, other long").withColumn(
        "duplicate", F.col("other") < F.col("doc_id"))
    before = (Window.partitionBy("doc_id", "tk").orderBy("start", F.desc("end"), F.desc("duplicate"), "other", F.desc("n_chunks"))
              .rowsBetween(Window.unboundedPreceding, -1))
    inside = F.coalesce(F.max(F.when(F.col("duplicate"), F.col("end"))).over(before) >= F.col("end"), F.lit(False))
    inside = inside | (~F.col("duplicate") & F.coalesce(F.max("end").over(before) >= F.col("end"), F.lit(False)))
    def name(c):
        return c if most is None else F.when(c <= most, c)
    return (spans.withColumn("inside", inside).filter("not inside")
            .select(name(F.col("doc_id")).alias("doc_id"), "start", "end", "n_chunks",
                    name(F.least("doc_id", "other")).alias("first_doc_id"), "duplicate"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return repeated_spans(table(spark, sf_dir, "documents", "doc_id", "text"))

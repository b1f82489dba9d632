"""Best-fit packing with several permitted sequence lengths.

Pieces are placed longest first.  A piece goes into the open bin whose rest
is the least that still holds it.  If there is none, a bin of the permitted
length with the least cost per token it can expect to hold is opened: its cost
is linear plus quadratic in its length, and it can expect the piece and the
smaller pieces still to come that fit beside it.  At the end every bin is cut
down to the shortest permitted length that holds its contents.

Lengths count token ids: a text's ids from the byte-level tokenizer and its end
id.  A text longer than the longest length is cut into pieces of that length
and a rest.  Rows are dealt evenly (round robin, whatever their keys) over
shards of bounded rows and ids, each packed by itself, so a shard's memory is
bounded; a shard wastes at most a few open bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.llm.common import prepare, ship, stored, table
from riskgraph.llm.pretokens import Coder
from riskgraph.llm.tokens import END, ENCODE_CHARS, TOKENIZER

ship(__name__)

LENGTHS = (512, 1024, 2048, 4096)
ATTENTION = 8192     # length at which the quadratic share of the cost equals the linear one
SHARD_ROWS = 100_000
SHARD_TOKENS = 6_000_000


def cost(length: int, attention: int = ATTENTION) -> float:
    return length * (1 + length / attention)


def pack(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS, attention: int = ATTENTION) -> tuple[np.ndarray, list[int]]:
    """(bin of each piece, final length of each bin) for pieces sorted longest
    first, all of 1 to max(lengths) tokens."""
    lengths = tuple(sorted(lengths))
    mass = np.concatenate([[0], np.cumsum(np.bincount(sizes, weights=sizes, minlength=lengths[-1] + 1))[1:]])
    left = float(mass[-1])           # tokens not yet placed
    where = np.empty(len(sizes), np.int64)
    rest: list[int] = []             # free tokens of each bin
    cap: list[int] = []
    by_rest: dict[int, list[int]] = {}
    free = 0                         # bit r is set if some bin has r tokens free
    for k, size in enumerate(sizes.tolist()):
        fits = free >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = by_rest[r].pop()
            if not by_rest[r]:
                free &= ~(1 << r)
        else:
            def price(c: int) -> float:
                beside = left - size if c - size >= size else min(left - size, float(mass[c - size]))
                return cost(c, attention) / (size + min(c - size, beside))
            c = min((c for c in lengths if c >= size), key=lambda c: (price(c), c))
            b, r = len(cap), c
            cap.append(c)
            rest.append(c)
        where[k] = b
        left -= size
        r -= size
        rest[b] = r
        if r:
            by_rest.setdefault(r, []).append(b)
            free |= 1 << r
    used = [c - r for c, r in zip(cap, rest, strict=True)]
    return where, [next(c for c in lengths if c >= u) for u in used]


_PIECES = "array<struct<doc_id: long, text_hash: long, start: long, length: long>>"
_IDS = pa.list_(pa.int32())


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each run, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _pack_shard(lengths: tuple[int, ...], attention: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        rows = pa.Table.from_batches(tables)
        n = rows.column("n").to_numpy()
        names = [rows.column(c).combine_chunks() for c in ("doc_id", "text_hash")]
        longest = max(lengths)
        parts = -(-n // longest)
        row = np.repeat(np.arange(len(n)), parts)
        part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = part * longest
        size = np.minimum(longest, n[row] - start)
        keys = [np.asarray(x.fill_null(np.iinfo(np.int64).min))[row] for x in names]
        order = np.lexsort((start, keys[1], keys[0], -size))
        row, start, size = row[order], start[order], size[order]
        where, caps = pack(size, lengths, attention)
        by_bin = np.argsort(where, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(caps)))])
        used = np.bincount(where, weights=size, minlength=len(caps)).astype(np.int64)
        first = TaskContext.get().partitionId() << 33
        row, start, size = row[by_bin], start[by_bin], size[by_bin]
        if with_ids:
            flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows.column("ids").chunks])
            begins = (np.cumsum(n) - n)[row] + start
        step = 250 if with_ids else 20_000
        for a in range(0, len(caps), step):
            z = min(len(caps), a + step)
            lo, hi = edges[a], edges[z]
            pieces = pa.StructArray.from_arrays(
                [*[x.take(pa.array(row[lo:hi])) for x in names], pa.array(start[lo:hi]), pa.array(size[lo:hi])],
                ["doc_id", "text_hash", "start", "length"])
            cells = [pa.array(first + np.arange(a, z)), pa.array(caps[a:z], pa.int64()), pa.array(used[a:z]),
                     pa.ListArray.from_arrays(pa.array((edges[a:z + 1] - lo).astype(np.int32)), pieces)]
            if with_ids:
                ids = flat[_gather(begins[lo:hi], size[lo:hi])].astype(np.int32)
                cuts = np.concatenate([[0], np.cumsum(used[a:z])]).astype(np.int32)
                cells.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids)))
            yield pa.RecordBatch.from_arrays(cells, ["bin_id", "capacity", "used", "pieces", "ids"][:len(cells)])
    return run


def best_fit(sizes: DataFrame, lengths: tuple[int, ...] = LENGTHS, attention: int = ATTENTION,
             shard_rows: int = SHARD_ROWS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Bins (bin_id, capacity, used, pieces) of rows (doc_id, n tokens).

    ``sizes`` may name its rows further by ``text_hash`` and hold their token
    ``ids`` (as many as n); the bins then hold theirs (``ids``, piece by piece).
    pieces are (doc_id, text_hash, start, length) in tokens.  Rows with null or
    no tokens have no piece; repeated rows and null doc_ids are packed like any
    other.  An empty table gives no bin.  A row's ids are one array, so a text
    has at most some 500 million.
    """
    with_ids = "ids" in sizes.columns
    text_hash = F.col("text_hash") if "text_hash" in sizes.columns else F.lit(None)
    rows = stored(sizes.select(F.col("doc_id").cast("long"), text_hash.cast("long").alias("text_hash"), F.col("n").cast("long"),
                               *(["ids"] if with_ids else [])).filter("n > 0"), "sizes")
    count, tokens = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(1, -(-count // shard_rows), -(-tokens // shard_tokens))
    return rows.repartition(shards).mapInArrow(
        _pack_shard(tuple(lengths), attention, with_ids),
        f"bin_id long, capacity long, used long, pieces {_PIECES}" + (", ids array<int>" if with_ids else ""))


def _encode(path: str, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(path)
        for batch in batches:
            texts, a = batch.column("text"), 0
            while a < len(texts):
                z, chars, some = a, 0, []
                while z < len(texts) and (z == a or chars < ENCODE_CHARS):
                    some.append(texts[z].as_py() or "")
                    chars += len(some[-1])
                    z += 1
                found = coder.encode(some)
                n = [len(x) + 1 if t else 0 for x, t in zip(found, some, strict=True)]
                cells = [*[batch.column(c).slice(a, z - a) for c in ("doc_id", "text_hash")], pa.array(n, pa.int64())]
                if with_ids:
                    cells.append(pa.array([np.append(x, end).astype(np.int32) if t else [] for x, t in zip(found, some, strict=True)], _IDS))
                yield pa.RecordBatch.from_arrays(cells, ["doc_id", "text_hash", "n", "ids"][:len(cells)])
                a = z
    return run


def token_counts(docs: DataFrame, tokenizer: str, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, text_hash, n, and ids if asked for) of each whole text: its ids
    and one end id; null and empty texts have none.  text_hash (64 bits) tells
    rows apart that share a doc_id or have none."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_encode(tokenizer, end, with_ids), "doc_id long, text_hash long, n long" + (", ids array<int>" if with_ids else ""))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    prepare(spark)
    return best_fit(token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(TOKENIZER)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the packed sequences of all documents left, with
    their token ids."""
    import public_tokenizers
    prepare(spark)
    return best_fit(token_counts(docs, public_tokenizers.path(TOKENIZER), with_ids=True))

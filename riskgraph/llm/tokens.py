"""Token ids as Arrow files of equal-length sequences.

Texts are encoded in ascending doc_id order; each text's ids are followed by
an end id.  A file is in the Arrow IPC file format.  Its record batches hold
rows of ``SEQUENCE`` ids as a fixed-size list, with a fixed-size list of mask
bits (false where the last row is filled up), so row ``i`` of a memory-mapped
file is found by arithmetic and read without a copy.  Ids are 16 bits wide
where the vocabulary allows, else 32.  Lists beside each row name the texts
that begin in it, where, and their ids.  A text never spans files.

Spark's own text writer puts the bytes in place, one row per file, through
its commit protocol: a lost or repeated task leaves no half file, and any
store that Spark can write will do.  The writer ends each row with a "line
separator"; the separator is set to the format's closing magic, which the row
leaves out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import new_folder, prepare, ship, small_side, stored, table
from riskgraph.llm.pretokens import Coder

ship(__name__)

SEQUENCE = 2048        # ids in a sequence
BATCH_ROWS = 256       # sequences in a record batch
FILE_IDS = 2 << 20     # ids after which a file is closed
TOKENIZER = "byte_bpe_50k.json"  # 50,257 ids
END = 2                # id appended to each text
MAGIC = "ARROW1"       # fixed value: closing magic of the file format
ENCODE_CHARS = 1 << 18  # characters encoded at once

_INDEX = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int32()), ("n", pa.int64())]))


def _schema(width: pa.DataType, sequence: int, meta: dict) -> pa.Schema:
    return pa.schema([("ids", pa.list_(width, sequence)), ("mask", pa.list_(pa.bool_(), sequence)), ("docs", _INDEX)],
                     {k: str(v) for k, v in meta.items()})


def file_bytes(ids: np.ndarray, docs: list[tuple], sequence: int, width: pa.DataType, meta: dict) -> bytes:
    """One file: ``ids`` of whole texts, ``docs`` (doc_id, first id, count)."""
    n = len(ids)
    rows = max(1, -(-n // sequence))
    flat = np.zeros(rows * sequence, np.uint16 if width == pa.uint16() else np.uint32)
    flat[:n] = ids
    mask = np.arange(rows * sequence) < n
    begins = np.array([d[1] for d in docs], np.int64)
    where = begins // sequence
    edges = np.searchsorted(where, np.arange(rows + 1)).astype(np.int32)
    index = pa.StructArray.from_arrays(
        [pa.array([d[0] for d in docs], pa.int64()), pa.array((begins % sequence).astype(np.int32)),
         pa.array([d[2] for d in docs], pa.int64())], ["doc_id", "at", "n"])
    index = pa.ListArray.from_arrays(pa.array(edges), index)
    schema = _schema(width, sequence, meta)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, schema) as out:
        for a in range(0, rows, BATCH_ROWS):
            z = min(rows, a + BATCH_ROWS)
            part = slice(a * sequence, z * sequence)
            out.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(flat[part], width), sequence),
                pa.FixedSizeListArray.from_arrays(pa.array(mask[part]), sequence),
                index.slice(a, z - a)], schema=schema))
    return sink.getvalue().to_pybytes()


class SequenceFile:
    """Random access to the sequences of one file, without copies."""

    def __init__(self, source):
        self.reader = pa.ipc.open_file(source)
        self.meta = {k.decode(): v.decode() for k, v in (self.reader.schema.metadata or {}).items()}
        self.sequence = self.reader.schema.field("ids").type.list_size

    def batch(self, k: int) -> np.ndarray:
        """Ids of a batch as a (rows, sequence) view of the file's bytes."""
        column = self.reader.get_batch(k).column("ids")
        return column.flatten().to_numpy(zero_copy_only=True).reshape(-1, self.sequence)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``i``; the ids are a view."""
        k, r = divmod(i, BATCH_ROWS)
        mask = self.reader.get_batch(k).column("mask").slice(r, 1).flatten()
        return self.batch(k)[r], np.asarray(mask)

    def texts(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id in the file, ids) of each text, in file order."""
        n = self.reader.num_record_batches
        flat = np.concatenate([self.batch(k).ravel() for k in range(n)]) if n > 1 else self.batch(0).ravel()
        row = 0
        for k in range(n):
            for begun in self.reader.get_batch(k).column("docs").to_pylist():
                for d in begun:
                    at = row * self.sequence + d["at"]
                    yield d["doc_id"], at, flat[at:at + d["n"]]
                row += 1


def _write_rows(path: str, sequence: int, file_ids: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(path)
        width = pa.uint16() if max(coder.size, end + 1) <= 1 << 16 else pa.uint32()
        kind = np.uint16 if width == pa.uint16() else np.uint32
        held: list[np.ndarray] = []
        docs: list[tuple] = []
        size = seq = 0
        part = TaskContext.get().partitionId()

        def close():
            nonlocal held, docs, size, seq
            data = file_bytes(np.concatenate(held), docs, sequence, width,
                              {"part": part, "seq": seq, "tokens": size, "end": end})
            held, docs, size, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([data[:-len(MAGIC)]], pa.binary())], ["content"])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            a = 0
            while a < len(ids):
                z, chars, some = a, 0, []
                while z < len(ids) and (z == a or chars < ENCODE_CHARS):
                    some.append(texts[z].as_py() or "")
                    chars += len(some[-1])
                    z += 1
                for doc_id, found in zip(ids[a:z], coder.encode(some), strict=True):
                    got = np.append(found, end).astype(kind)
                    docs.append((doc_id, size, len(got)))
                    held.append(got)
                    size += len(got)
                    if size >= file_ids:
                        yield close()
                a = z
        if held:
            yield close()
    return run


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, sequence: int = SEQUENCE,
                    file_ids: int = FILE_IDS, end: int = END) -> None:
    """Encode ``docs`` (doc_id, text; null text is empty, null ids come first)
    in ascending doc_id order into files under ``folder``.  An empty table
    leaves no file."""
    order = [F.col("doc_id"), F.xxhash64("text")]  # rows that share an id spread too
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    (ordered.mapInArrow(_write_rows(tokenizer, sequence, file_ids, end), "content binary")
     .select(F.col("content").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", MAGIC).text(folder))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            if not content.as_buffer().size:
                continue  # a task without rows leaves an empty file
            f = SequenceFile(pa.BufferReader(content.as_buffer()))
            rows = [(d, at, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, at, x in f.texts()]
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(f.meta[k])] * n, pa.int64()) for k in ("part", "seq")]
                + [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (part, seq, doc_id, at, n_tokens, ids_crc32) read from the files:
    ``at`` is the first id's place in file (part, seq)."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(_read, "part long, seq long, doc_id long, at long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """Write ``docs`` as sequences into the shared folder and return, read
    from the files, doc_id, start, n_tokens, ids_crc32 per row.

    ``start`` counts the ids of all rows before, by doc_id; rows that share a
    doc_id follow each other in order of their text's hash.  The running total
    is taken over files (one row each), not texts.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "sequences")
    write_sequences(docs, folder, tokenizer, **how)
    found = stored(read_texts(spark, folder), "texts")
    files = found.groupBy("part", "seq").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    files = stored(files.select("part", "seq", F.coalesce(before, F.lit(0)).alias("base")), "files")
    return (found.join(small_side(files, 40), ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    prepare(spark)
    return token_index(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(TOKENIZER))

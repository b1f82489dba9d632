"""Language-model scores from Brown classes.

The model is a class bigram: P(w | v) = P(class(w) | class(v)) * P(w | class(w)).
A text is its words and one end; the end before it is its first context.

1. Texts are coded once: chunks of about two million tokens, each with its own
   list of distinct words and the word numbers in text order (stored).
2. The counts of all words of all training texts come from these lists.
3. Words with at least a 50,000th of the training tokens (so at most 50,000,
   whatever the corpus) are clustered by exchange.  Their neighbour counts are
   one table of pairs, aggregated by Spark and packed by word, so that every
   round finds all neighbours of a word in one place and shuffles nothing: a
   word is taken out of its class and put where the likelihood of the class
   bigrams gains most.  Words move in alternating halves, with class counts
   renewed in between; a round that loses likelihood is undone and ends it.
4. All other words seen twice or more are put by the same gain beside them:
   the classes before and after each occurrence meet by word, and the word goes
   to the class where the likelihood gains most.  Words seen once stand for the
   unseen ones and share their class.
5. Counts and classes of each chunk's words are joined to it by chunk, so no
   task holds more than a chunk's vocabulary.  Class bigrams are counted over
   all training texts and every text is scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.llm.common import discard, prepare, ship, stored, table

ship(__name__)

CORE = 50_000          # a word with at least this fraction of the tokens is clustered
CLASSES = 64
ROUNDS = 8             # half rounds of the exchange, at most
BUCKETS = 512          # packed parts of the neighbour table
SMOOTHING = 16.0       # weight of the class's own probability in a transition
CHUNK_TOKENS = 1 << 21
PAIRS_HELD = 3_000_000  # distinct neighbour pairs a task holds before it passes them on
ROWS_PLACED = 5_000    # rows of other words that are placed at once

END = 0                          # class of the end; clustered classes are 1 to CLASSES
RARE = CLASSES + 1               # class of words seen once or never; any other word while the core is clustered
ALL_CLASSES = RARE + 1

# Fixed values of the contract: A-Z lower-cased, words are runs of anything else than white space.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

CHUNK = ("chunk long, n_words int, tokens binary, sizes array<long>, doc_ids array<long>, held array<boolean>, "
         "words array<binary>, counts array<long>")
_CHUNK = pa.schema([("chunk", pa.int64()), ("n_words", pa.int32()), ("tokens", pa.binary()), ("sizes", pa.list_(pa.int64())),
                    ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                    ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; bytes.split() cuts at space, 0x09-0x0D."""
    return text.translate(_LOWER).split() if text else []


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coded chunks of the texts read; word 0 of a chunk is the end."""
    number = TaskContext.get().partitionId() << 32
    known, parts, docs, held_tokens = {b"": 0}, [], [], 0

    def chunk() -> pa.RecordBatch:
        sizes = np.array([len(p) for p in parts], np.int64)
        tokens = np.concatenate(parts)
        held = np.array([d[1] for d in docs])
        counts = np.bincount(tokens[~np.repeat(held, sizes)], minlength=len(known))
        row = {"chunk": number, "n_words": len(known), "tokens": zstandard.compress(tokens.tobytes(), 1), "sizes": sizes, "doc_ids": [d[0] for d in docs],
               "held": held, "words": list(known), "counts": counts}
        return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _CHUNK], schema=_CHUNK)

    for batch in batches:
        for doc_id, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
            found = words(text)
            ids = np.zeros(len(found) + 1, np.int32)
            ids[:-1] = [known.setdefault(w, len(known)) for w in found]
            parts.append(ids)
            docs.append((doc_id, out))
            held_tokens += len(ids)
            if held_tokens >= CHUNK_TOKENS:
                yield chunk()
                number += 1
                known, parts, docs, held_tokens = {b"": 0}, [], [], 0
    if parts:
        yield chunk()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _tokens(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), np.int32)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(back, np.concatenate(counts), len(distinct)).astype(np.int64)


def _neighbour_pairs(core: list[bytes]):
    """(key, n) of neighbours in training texts, one of them a core word; key is
    first * (core + 2) + second, with two numbers beyond the core for the end
    and for any other word."""
    def run(batches):
        place, k = {w: i for i, w in enumerate(core)}, len(core)
        keys, counts, held = [], [], 0

        def out():
            x, n = _merged(keys, counts)
            for a in range(0, len(x), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[a:a + 100_000]), pa.array(n[a:a + 100_000])], ["key", "n"])

        for row in _rows(batches):
            number = np.array([place.get(w, k + 1) for w in row["words"]], np.int64)
            number[0] = k
            tokens = number[_tokens(row["tokens"])]
            tokens = tokens[~np.repeat(np.array(row["held"], bool), row["sizes"])]
            before = np.concatenate([[k], tokens[:-1]])  # every text ends with the end
            both = (before < k) | (tokens < k)
            x, n = np.unique(before[both] * (k + 2) + tokens[both], return_counts=True)
            keys.append(x)
            counts.append(n)
            held += len(x)
            if held >= PAIRS_HELD:
                yield from out()
                keys, counts, held = [], [], 0
        if keys:
            yield from out()
    return run


def _pack(rows: pa.Table) -> pa.Table:
    """One row for all neighbours of a bucket's words."""
    cells = [np.ascontiguousarray(rows.column(c).to_numpy()).astype(t).tobytes()
             for c, t in (("word", np.int32), ("other", np.int32), ("side", np.int8), ("n", np.int64))]
    return pa.table([pa.array([c], pa.binary()) for c in cells], names=["word", "other", "side", "n"])


def _neighbours(chunks: DataFrame, core: list[bytes]) -> DataFrame:
    """Packed neighbour counts (word, other, side, n) by buckets of core words
    (stored); side 0: the other word follows, 1: it precedes."""
    k = len(core)
    pairs = chunks.select("tokens", "sizes", "held", "words").mapInArrow(_neighbour_pairs(core), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    first, second = F.floor(F.col("key") / (k + 2)).cast("int"), (F.col("key") % (k + 2)).cast("int")
    side = F.explode(F.array(F.struct(first.alias("word"), second.alias("other"), F.lit(0).alias("side")),
                             F.struct(second.alias("word"), first.alias("other"), F.lit(1).alias("side"))))
    rows = pairs.select(side.alias("r"), "n").select("r.*", "n").filter(F.col("word") < k)
    # A bucket has at most CORE / BUCKETS words and twice CORE neighbours for each.
    packed = (rows.withColumn("bucket", F.col("word") % BUCKETS).groupBy("bucket")
              .applyInArrow(_pack, "word binary, other binary, side binary, n binary"))
    return stored(packed, "neighbours")


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[c], t) for c, t in (("word", np.int32), ("other", np.int32), ("side", np.int8), ("n", np.int64)))


def _class_pairs(classes: np.ndarray, k: int, size: int):
    """Counts of class pairs, one of them clustered."""
    def run(batches):
        total = np.zeros(size * size, np.int64)
        for row in _rows(batches):
            word, other, side, n = _unpack(row)
            once = (side == 0) | (other >= k)  # a pair of two core words stands on both sides
            a = np.where(side == 0, classes[word], classes[other])[once]
            b = np.where(side == 0, classes[other], classes[word])[once]
            np.add.at(total, a * size + b, n[once])
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])
    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(pairs: np.ndarray) -> float:
    """The part of the class bigram log likelihood that classes change."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(0)).sum() - _xlogx(pairs.sum(1)).sum())


def best_class(pairs: np.ndarray, own: int, left: np.ndarray, right: np.ndarray, choices: np.ndarray) -> int:
    """The class that gains most by a word with these neighbour classes, once
    it has left its own; ties go to the class it had, then to the first."""
    n = pairs.copy()
    n[:, own] -= left
    n[own, :] -= right
    n = np.maximum(n, 0)
    rows, cols = n.sum(1), n.sum(0)
    gain = ((_xlogx(n + left[:, None]) - _xlogx(n)).sum(0) + (_xlogx(n + right[None, :]) - _xlogx(n)).sum(1)
            - (_xlogx(rows + right.sum()) - _xlogx(rows)) - (_xlogx(cols + left.sum()) - _xlogx(cols)))[choices]
    top = gain.max()
    return own if gain[choices == own].max(initial=-np.inf) >= top - 1e-9 else int(choices[gain.argmax()])


def _moves(classes: np.ndarray, pairs: np.ndarray, half: int, size: int):
    """(word, class) of the words of one half that change class."""
    def run(batches):
        choices = np.arange(1, CLASSES + 1)
        for row in _rows(batches):
            word, other, side, n = _unpack(row)
            order = np.argsort(word, kind="stable")
            word, other, side, n = word[order], other[order], side[order], n[order]
            edges = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1], [True]]))
            moved = []
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                w = int(word[a])
                if w // BUCKETS % 2 != half:
                    continue
                c, s, m = classes[other[a:z]], side[a:z], n[a:z]
                right = np.bincount(c[s == 0], m[s == 0], size)
                left = np.bincount(c[s == 1], m[s == 1], size)
                best = best_class(pairs, int(classes[w]), left, right, choices)
                if best != classes[w]:
                    moved.append((w, best))
            if moved:
                w, c = zip(*moved, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.int64()), pa.array(c, pa.int64())], ["word", "class"])
    return run


def class_pairs(neighbours: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """Counts of (class, next class) under ``classes`` of the ``k`` core words,
    the end and any other word."""
    size = RARE + 1
    cells = (neighbours.mapInArrow(_class_pairs(classes, k, size), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # at most size * size rows
    out = np.zeros(size * size)
    for r in cells:
        out[r["cell"]] = r["n"]
    return out.reshape(size, size)


def exchange(neighbours: DataFrame, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Classes 1 to ``CLASSES`` of the ``k`` core words, numbered from the most
    frequent, by exchange from a start that deals them in turn."""
    size = RARE + 1  # the end, the clustered classes and one for all other words
    classes = np.concatenate([1 + np.arange(k) % CLASSES, [END, RARE]])
    pairs = class_pairs(neighbours, classes, k)
    before = likelihood(pairs)
    for half in range(rounds):
        moves = neighbours.mapInArrow(_moves(classes, pairs, half % 2, size), "word long, class long").collect()
        if not moves:
            continue
        changed = classes.copy()
        for r in moves:  # at most one a core word
            changed[r["word"]] = r["class"]
        renewed = class_pairs(neighbours, changed, k)
        after = likelihood(renewed)
        if after < before:
            break
        classes, pairs, before = changed, renewed, after
    return classes[:k]


def _contexts(core: list[bytes], classes: np.ndarray):
    """(word, around) per chunk and word outside the core in training texts:
    two bytes an occurrence, the classes before and after it."""
    def run(batches):
        place = dict(zip(core, classes.tolist(), strict=True))
        for batch in batches:
            for k in range(batch.num_rows):
                yield from chunk(batch, k, place)

    def chunk(batch, k, place):
        known = batch.column("words")[k].values
        kind = np.array([place.get(w, RARE) for w in known.to_pylist()], np.uint8)
        kind[0] = END
        tokens = _tokens(batch.column("tokens")[k].as_py())
        held = batch.column("held")[k].values.to_numpy(zero_copy_only=False)
        tokens = tokens[~np.repeat(held, _array(batch, "sizes", k))]
        now = kind[tokens]
        at = np.flatnonzero(now == RARE)
        at = at[np.argsort(tokens[at], kind="stable")]
        word = tokens[at]
        around = np.stack([np.where(at > 0, now[at - 1], END), now[np.minimum(at + 1, len(now) - 1)]], 1).astype(np.uint8)  # a text ends with the end
        first = np.flatnonzero(np.diff(word, prepend=-1))
        stops = np.append(first, len(word))
        for a in range(0, len(first), 20_000):
            z = min(len(first), a + 20_000)
            edges = (2 * (stops[a:z + 1] - stops[a])).astype(np.int32)
            cells = pa.Array.from_buffers(pa.binary(), z - a, [None, pa.py_buffer(edges), pa.py_buffer(around[stops[a]:stops[z]].tobytes())])
            yield pa.RecordBatch.from_arrays([known.take(pa.array(word[first[a:z]])), cells], ["word", "around"])
    return run


def _gains(table: np.ndarray, word: np.ndarray, beside: np.ndarray, n_words: int) -> np.ndarray:
    """(word, class) gain in x log x by the neighbours of one side; ``table`` has
    the pair counts by (neighbour class, class)."""
    size = len(table)
    cell, n = np.unique(word * size + beside, return_counts=True)
    more = _xlogx(table[cell % size] + n[:, None]) - _xlogx(table)[cell % size]
    return np.add.reduceat(more, np.searchsorted(cell // size, np.arange(n_words)))


def places(pairs: np.ndarray, word: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The class that gains most by each of the words 0, 1, ..., given one word
    number and the classes before and after it per occurrence; ties go to the
    first class."""
    choices = np.arange(1, CLASSES + 1)
    n = np.bincount(word)
    gain = _gains(pairs[:, choices], word, left, len(n)) + _gains(pairs[choices].T, word, right, len(n))
    for whole in (pairs.sum(1)[choices], pairs.sum(0)[choices]):
        gain -= _xlogx(whole + n[:, None]) - _xlogx(whole)
    return choices[np.round(gain, 9).argmax(1)]


def _placed(pairs: np.ndarray):
    """(word, n, class) of words in order, from their occurrences in all chunks."""
    def block(rows: pa.Table, fresh: np.ndarray) -> pa.RecordBatch:
        around = rows.column("around").combine_chunks()
        edges = np.frombuffer(around.buffers()[1], np.int32)[around.offset:around.offset + len(around) + 1]
        cells = np.frombuffer(around.buffers()[2], np.uint8)[edges[0]:edges[-1]].reshape(-1, 2).astype(np.int64)
        word = np.repeat(np.cumsum(fresh) - 1, np.diff(edges) // 2)
        n = np.bincount(word)
        kind = np.full(len(n), RARE)
        often = n[word] > 1
        if often.any():
            kind[n > 1] = places(pairs, np.unique(word[often], return_inverse=True)[1], *cells[often].T)
        return pa.RecordBatch.from_arrays([rows.column("word").combine_chunks().take(pa.array(np.flatnonzero(fresh))),
                                           pa.array(n), pa.array(kind.astype(np.int32))], ["word", "n", "class"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < ROWS_PLACED:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            fresh = starts(rows)
            last = int(np.flatnonzero(fresh)[-1])  # the last word may go on in the next batch
            if last:
                yield block(rows.slice(0, last), fresh[:last])
            held, n = rows.slice(last).to_batches(), n - last
        if n:
            rows = pa.Table.from_batches(held).combine_chunks()
            yield block(rows, starts(rows))

    def starts(rows: pa.Table) -> np.ndarray:
        word = rows.column("word").combine_chunks()
        return np.concatenate([[True], pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)])
    return run


def _vocabulary(chunks: DataFrame) -> DataFrame:
    """(word, n) of the training tokens (stored)."""
    held = chunks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.words", "w.counts").filter("counts > 0")
    return stored(held.groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("n")), "words")


def _classed(chunks: DataFrame, core: list[tuple[bytes, int]], classes: np.ndarray, pairs: np.ndarray, ends: int) -> DataFrame:
    """(word, n, class) of every training word (stored)."""
    spark = chunks.sparkSession
    known = [(w, n, int(c)) for (w, n), c in zip(core, classes, strict=True)] + ([(b"", ends, END)] if ends else [])
    # Rows of a word stand together: at most a CORE-th of the tokens, two bytes each.
    others = (chunks.select("tokens", "sizes", "held", "words").mapInArrow(_contexts([w for w, _ in core], classes), "word binary, around binary")
              .repartition("word").sortWithinPartitions("word").mapInArrow(_placed(pairs), "word binary, n long, class int"))
    return stored(others.unionByName(spark.createDataFrame(known, "word binary, n long, class int")), "classes")


def _array(batch: pa.RecordBatch, name: str, k: int) -> np.ndarray:
    """Row ``k`` of a list column."""
    values = batch.column(name)[k].values
    return np.empty(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False)


def _code(total: int, distinct: int, class_size: np.ndarray, once: int):
    """Per document its counts, base score, emission score and class sequence."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield from chunk(batch, k)

    def chunk(batch, k):
        size = batch.column("n_words")[k].as_py()
        n, kind = np.zeros(size, np.int64), np.full(size, RARE, np.uint8)
        kind[0] = END
        at = _array(batch, "pos", k)
        n[at], kind[at] = _array(batch, "n", k), _array(batch, "class", k)
        base = np.log10((n + 1) / (total + distinct + 1))
        emission = np.where(kind == RARE, (1 + (n > 0)) / (2 * once + 1), np.maximum(n, 1) / np.maximum(class_size[kind], 1))
        emission = np.log10(emission)
        emission[0] = 0.0
        tokens = _tokens(batch.column("tokens")[k].as_py())
        sizes = _array(batch, "sizes", k)
        stops = np.cumsum(sizes)
        first = stops - sizes
        sums = [np.add.reduceat(x[tokens], first) for x in ((n > 0).astype(np.int64), base, emission)]
        codes = kind[tokens].tobytes()
        ids, held = batch.column("doc_ids")[k].values, batch.column("held")[k].values
        for a in range(0, len(sizes), 500):
            z = min(len(sizes), a + 500)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, z - a), held.slice(a, z - a), pa.array(sizes[a:z]), *[pa.array(s[a:z]) for s in sums],
                 pa.array([codes[i:j] for i, j in zip(first[a:z], stops[a:z], strict=True)], pa.binary())],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "emission", "codes"])
    return run


def _sequence(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(previous class, class) of all tokens: a text's last class is the end,
    which is the next one's first context."""
    now = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).astype(np.int64)
    return np.concatenate([[END], now[:-1]]), now


def _transitions(batches):
    total = np.zeros(ALL_CLASSES ** 2, np.int64)
    for batch in batches:
        if batch.num_rows:
            before, now = _sequence(batch)
            total += np.bincount(before * ALL_CLASSES + now, minlength=len(total))
    cell = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])


def _score(transition: np.ndarray):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            before, now = _sequence(batch)
            sizes = batch.column("n_tokens").to_numpy()
            moved = np.add.reduceat(transition[before, now], np.cumsum(sizes) - sizes)
            score = moved + batch.column("emission").to_numpy()
            keep = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(score), pa.array(10.0 ** np.minimum(-score / sizes, 300))],
                [*keep, "score", "perplexity"])
    return run


def transition_logs(counts: np.ndarray) -> np.ndarray:
    """log10 P(class | class before): counts smoothed by the class's own share."""
    own = counts.sum(0) + 1.0
    return np.log10((counts + SMOOTHING * own / own.sum()) / (counts.sum(1, keepdims=True) + SMOOTHING))


def class_scores(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text, held_out), learned from
    the rows that are not held out: doc_id, held_out, n_tokens, n_known (tokens
    seen in training), train_tokens, base_score (log10 of the text under add-one
    unigrams), score (log10 under the class model), perplexity.

    Null and empty texts are one end.  Repeated rows are texts of their own,
    and so are rows without a doc_id.  Without training rows nothing is known
    and all words are alike.  An empty table gives no rows.  A text is one
    array of a task: it may have some 500 million words.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("held_out"), F.col("text").cast("binary"))
    chunks = stored(rows.mapInArrow(_chunks, CHUNK), "chunks")
    vocabulary = _vocabulary(chunks)
    total, distinct = (int(x or 0) for x in vocabulary.agg(F.sum("n"), F.count("*")).first())
    frequent = vocabulary.filter((F.col("n") * CORE >= total) | (F.octet_length("word") == 0)).collect()
    found = sorted(((bytes(r["word"]), r["n"]) for r in frequent), key=lambda r: (-r[1], r[0]))
    ends = sum(n for w, n in found if not w)
    core = [(w, n) for w, n in found if w]
    k = len(core)
    classes, pairs = np.empty(0, np.int64), np.zeros((RARE + 1, RARE + 1))
    if core:
        neighbours = _neighbours(chunks, [w for w, _ in core])
        classes = exchange(neighbours, k)
        pairs = class_pairs(neighbours, np.concatenate([classes, [END, RARE]]), k)
        discard(neighbours)
    classed = _classed(chunks, core, classes, pairs, ends)
    discard(vocabulary)
    class_size, once = np.zeros(ALL_CLASSES), 0
    for r in classed.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        class_size[r["class"]] = r["n"]
        once = r["words"] if r["class"] == RARE else once

    # Each chunk's words with their counts and classes go back to it.
    place = chunks.select("chunk", F.posexplode("words").alias("pos", "word"))
    found = (place.join(classed, "word").groupBy("chunk").agg(F.collect_list(F.struct("pos", "n", "class")).alias("f"))
             .select("chunk", *[F.col(f"f.{c}").alias(c) for c in ("pos", "n", "class")]))
    coded = stored(chunks.drop("words", "counts").join(found, "chunk", "left").mapInArrow(
        _code(total, distinct, class_size, once), "doc_id long, held_out boolean, n_tokens long, n_known long, "
        "base_score double, emission double, codes binary"), "coded")
    discard(chunks, classed)

    counts = np.zeros(ALL_CLASSES ** 2)
    cells = coded.filter("not held_out").select("codes").mapInArrow(_transitions, "cell long, n long")
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most ALL_CLASSES ** 2 rows
        counts[r["cell"]] = r["n"]
    transition = transition_logs(counts.reshape(ALL_CLASSES, ALL_CLASSES))
    scored = coded.mapInArrow(_score(transition), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                              "base_score double, score double, perplexity double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                         "base_score", "score", "perplexity")


def held_out(doc_id: str, folds: int, fold: int):
    """Whether the checksum of a doc_id's text falls in a fold; rows without a
    doc_id never do."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def op13_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return class_scores(docs.withColumn("held_out", held_out("doc_id", 7, 2)))

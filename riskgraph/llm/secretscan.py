"""Secret scan: base patterns plus sliding-window entropy.

Base kinds are three patterns; their matches always stay.  The method adds
spans of kind ``entropy``: a candidate is a maximal run of token characters
of at least one window.  A window slides over it one character at a time; the
counts of its characters, and from them the Shannon entropy, are updated for
the character that leaves and the one that enters.  A candidate's character
class sets the threshold.  The span runs from the first window at or over the
threshold to the end of the last.  Candidates on the allow-list, and those
that overlap a base span, are suppressed.

Everything is DataFrame operations.  Offsets come from the lengths between
matches, summed by a window over one text's matches, so a text may hold any
number of them.  Texts are keyed by two independent 64-bit hashes: copies are
summarised once.  The work is linear in a text, however long its runs are and
however many spans it has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import measured_side, prepare, stored, table

# Fixed values of the contract.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "entropy"]

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
# Character classes, first match wins: pattern of the whole candidate, bits per character.
CLASSES = [("hex", r"^[0-9a-fA-F]+$", 3.03), ("alnum", r"^[0-9A-Za-z]+$", 3.63), ("base64", r"^.*$", 3.73)]
# What looks random to a window but is not a secret: prose and slugs, numbers
# and dates, UUIDs, marked placeholders, rows of one character.
ALLOW = [r"^[A-Za-z+/_=-]+$", r"^[0-9+/_=-]+$", r"^[A-Za-z]*[0-9]{0,4}$",
         r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
         r"(?i)example|sample|dummy|placeholder|redacted", r"(.)\1{7}"]
MASK = "[SECRET]"
PER_LONG = 12  # counts of a window (0 to 20, five bits each) held in one long


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _text_key() -> tuple[Column, Column]:
    """Two hashes of a text; the second starts from another seed, as the
    constant goes first."""
    return F.xxhash64(_text()), F.xxhash64(F.lit(1), _text())


def _matches(kind: str, pattern: str, when: Column) -> Column:
    """Array of (kind, i, gap, bytes, m): the i-th match and the length, in
    characters and in bytes, of the text between the match before and it."""
    none = F.expr("cast(array() as array<struct<kind:string,i:int,gap:int,bytes:int,m:string>>)")
    m = F.regexp_extract_all(_text(), F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(F.split(_text(), pattern, -1).alias("p"), m.alias("m"))
    rows = F.transform(F.slice(zipped, 1, F.size(m)), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x["p"]).alias("gap"), F.octet_length(x["p"]).alias("bytes"), x["m"].alias("m")))
    return F.when(when & (F.size(m) > 0), rows).otherwise(none)


def _entropy_extent(word: str) -> Column:
    """Struct (first, last): window beginnings at or over the class threshold,
    by incremental counts; nulls if there is none.  The word is turned into
    character codes once; the counts are packed into a few longs."""
    g = ", ".join(repr(c * math.log2(c)) + "D" if c > 1 else "0D" for c in range(WINDOW + 1))
    bits = " ".join(f"when {word} rlike '{p}' then {t}D" for _, p, t in CLASSES)

    def count(code):
        return f"int(shiftright(x.a.c[{code} div {PER_LONG}], int(5 * ({code} % {PER_LONG}))) & 31)"

    def one(code):
        return f"if(k = {code} div {PER_LONG}, shiftleft(1L, int(5 * ({code} % {PER_LONG}))), 0L)"

    # a.s is the sum of c * log2(c) over the counts c of the window's characters.
    return F.expr(f"""
      transform(array(transform(split({word}, ''), ch -> instr('{ALPHABET}', ch) - 1)), codes ->
        aggregate(sequence(1, length({word})),
          named_struct('c', array_repeat(0L, {-(-len(ALPHABET) // PER_LONG)}), 's', 0D,
                       'first', cast(null as int), 'last', cast(null as int),
                       'least', {WINDOW}D * (log2({WINDOW}D) - case {bits} end)),
          (a, i) -> transform(array(named_struct('a', a, 'in', codes[i - 1], 'out', if(i > {WINDOW}, codes[greatest(i - {WINDOW}, 1) - 1], -1))), x ->
            transform(array(named_struct(
              's', if(x.in = x.out, x.a.s, x.a.s + array({g})[{count('x.in')} + 1] - array({g})[{count('x.in')}]
                + if(x.out >= 0, array({g})[greatest({count('greatest(x.out, 0)')} - 1, 0)] - array({g})[{count('greatest(x.out, 0)')}], 0D)),
              'c', transform(x.a.c, (v, k) -> v + {one('x.in')} - if(x.out >= 0, {one('greatest(x.out, 0)')}, 0L)))), y ->
              named_struct('c', y.c, 's', y.s,
                'first', coalesce(x.a.first, if(i >= {WINDOW} and y.s <= x.a.least, i - {WINDOW}, null)),
                'last', if(i >= {WINDOW} and y.s <= x.a.least, i - {WINDOW}, x.a.last),
                'least', x.a.least))[0])[0],
          a -> named_struct('first', a.first, 'last', a.last)))[0]""")


def secret_spans(docs: DataFrame) -> DataFrame:
    """Spans (k1, k2, kind, k, start, end, from, upto) of the distinct texts of
    ``docs`` (column text); k orders the kinds.  start and end are code points,
    from and upto bytes, ends exclusive."""
    text = _text()
    lower = F.lower(text)
    has_word = F.lit(False)
    for w in ("password", "passwd", "secret", "token", "api"):
        has_word = has_word | F.contains(lower, F.lit(w))
    k1, k2 = _text_key()
    found = docs.select("text").select(
        k1.alias("k1"), k2.alias("k2"), F.explode(F.concat(
            _matches("assign", ASSIGN, has_word),
            _matches("access", ACCESS, F.contains(text, F.lit("AKIA"))),
            _matches("hex", HEX, text.rlike(r"[0-9a-f]{24}")),
            _matches("entropy", CANDIDATE, text.rlike(r"[A-Za-z0-9+/_=-]{20}")))).alias("f"))
    found = found.select("k1", "k2", "f.*").distinct()
    order = Window.partitionBy("k1", "k2", "kind").orderBy("i")
    # Matches are ASCII: as many bytes as characters.
    found = (found.withColumn("end", F.sum(F.col("gap") + F.length("m")).over(order))
             .withColumn("upto", F.sum(F.col("bytes") + F.length("m")).over(order))
             .withColumn("start", F.col("end") - F.length("m")).withColumn("from", F.col("upto") - F.length("m")))
    allowed = F.lit(False)
    for p in ALLOW:
        allowed = allowed | F.col("m").rlike(p)
    keep = (F.when(F.col("kind") == "assign", F.length(F.regexp_extract("m", ASSIGN, 1)) >= ASSIGN_LEAST)
            .when(F.col("kind") == "entropy", ~allowed).otherwise(True))
    found = found.filter(keep)
    # Only what is left of the candidates pays for the windows.
    found = (found.select("*", F.explode(F.array(F.when(F.col("kind") == "entropy", _entropy_extent("m")))).alias("w"))
             .filter("kind != 'entropy' or w.first is not null"))
    cut = F.when(F.col("kind") == "entropy", F.col("w.first")).otherwise(0)
    size = F.when(F.col("kind") == "entropy", F.col("w.last") + WINDOW - F.col("w.first")).otherwise(F.length("m"))
    found = found.select("k1", "k2", "kind", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("k"),
                         (F.col("start") + cut).alias("start"), (F.col("start") + cut + size).alias("end"),
                         (F.col("from") + cut).alias("from"), (F.col("from") + cut + size).alias("upto"))
    base = F.col("kind") != "entropy"
    by_text = Window.partitionBy("k1", "k2").orderBy("start", "k")
    before = F.max(F.when(base, F.col("end"))).over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.min(F.when(base, F.col("start"))).over(by_text.rowsBetween(1, Window.unboundedFollowing))
    return (found.withColumn("before", before).withColumn("behind", behind)
            .filter(base | ((F.coalesce("before", F.lit(0)) <= F.col("start"))
                            & (F.coalesce("behind", F.col("end")) >= F.col("end"))))
            .drop("before", "behind"))


def _facts(docs: DataFrame) -> DataFrame:
    """Per distinct text with a span: counts and the ordered spans."""
    s = F.sort_array(F.collect_list(F.struct("start", "k", "kind", "end")))
    n = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS]
    return stored(secret_spans(docs).groupBy("k1", "k2").agg(*n, s.alias("found")), "secrets")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_assign, n_access, n_hex,
    n_entropy, base_sha256, spans.  Null and empty texts have no span (the
    digest of an empty string); repeated rows repeat their result."""
    facts = _facts(docs)
    k1, k2 = _text_key()
    none = F.expr("cast(array() as array<struct<start:bigint,k:bigint,kind:string,end:bigint>>)")
    found = F.coalesce("found", none)
    return (docs.select("doc_id", k1.alias("k1"), k2.alias("k2"))
            .join(measured_side(facts), ["k1", "k2"], "left")
            .select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
                    F.sha2(_joined(F.filter(found, lambda s: s["kind"] != "entropy")), 256).alias("base_sha256"),
                    _joined(found).alias("spans")))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def _pieces(docs: DataFrame) -> DataFrame:
    """Per distinct text with a span, the bytes that stay (__k1, __k2,
    __pieces: (from, size) between the masks, __rest: where the last piece
    begins).  Spans that overlap are one mask."""
    by_text = Window.partitionBy("k1", "k2").orderBy("from", "k")
    covered = F.coalesce(F.max("upto").over(by_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = secret_spans(docs).withColumn("covered", covered)
    piece = F.when((F.col("from") >= F.col("covered")), F.struct("covered", (F.col("from") - F.col("covered")).alias("size")))
    return stored(spans.groupBy(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).agg(
        F.sort_array(F.collect_list(piece)).alias("__pieces"), F.max("upto").alias("__rest")), "masks")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every span is masked and n_chars follows; all documents
    stay.  The text is cut by bytes, each once, and joined with the mask."""
    prepare(spark)
    pieces = measured_side(_pieces(docs.select("text")))
    k1, k2 = _text_key()
    masked = F.expr(f"""
      transform(array(cast(text as binary)), b -> array_join(concat(
        transform(__pieces, p -> cast(substring(b, int(p.covered) + 1, int(p.size)) as string)),
        array(cast(substring(b, int(__rest) + 1) as string))), '{MASK}'))[0]""")
    out = (docs.join(pieces, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left")
           .withColumn("text", F.when(F.col("__pieces").isNotNull(), masked).otherwise(F.col("text"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__pieces").isNotNull(), F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_DUCK_ASSIGN = ("(?:" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
                + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
_DUCK_ALLOWED = " OR ".join(f"regexp_matches(m, '{p}')" for p in ALLOW if p != r"(.)\1{7}")
_DUCK_BITS = " ".join(f"WHEN regexp_matches(m, '{p}') THEN {t}" for _, p, t in CLASSES)
_DUCK_ROWS = " UNION ALL ".join(
    f"SELECT doc_id, '{kind}' AS kind, {k + 1} AS k, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS g FROM d"
    for k, (kind, p) in enumerate(zip(KINDS, (_DUCK_ASSIGN, ACCESS, HEX, CANDIDATE), strict=True)))
_SAME = " OR ".join(f"contains(m, '{c * 8}')" for c in ALPHABET)
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({_DUCK_ROWS}),
flat AS (
  SELECT doc_id, kind, k, unnest(m) AS m, unnest(g[1:len(m)]) AS g, unnest(range(0, len(m))) AS i FROM raw WHERE len(m) > 0
), placed AS (
  SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e FROM flat
), kept AS (
  SELECT doc_id, kind, k, e - length(m) AS s, e, m FROM placed
  WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(m, '{_DUCK_ASSIGN}', 1)) >= {ASSIGN_LEAST}
                  WHEN 'entropy' THEN NOT ({_DUCK_ALLOWED} OR {_SAME}) ELSE true END
), hot AS (
  SELECT doc_id, kind, k, s, m, list_filter(range(0, length(m) - {WINDOW} + 1),
      lambda i: list_aggregate(string_split(substr(m, i + 1, {WINDOW}), ''), 'entropy') >= CASE {_DUCK_BITS} END) AS w
  FROM kept WHERE kind = 'entropy'
), added AS (
  SELECT doc_id, kind, k, s + w[1] AS s, s + w[-1] + {WINDOW} AS e FROM hot WHERE len(w) > 0
), spans AS (
  SELECT doc_id, kind, k, s, e FROM kept WHERE kind <> 'entropy'
  UNION ALL
  SELECT doc_id, kind, k, s, e FROM added a
  WHERE NOT EXISTS (SELECT 1 FROM kept b WHERE b.kind <> 'entropy' AND b.doc_id = a.doc_id AND b.s < a.e AND a.s < b.e)
), facts AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'entropy') AS n_entropy,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) FILTER (kind <> 'entropy') AS base,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN facts USING (doc_id)
"""

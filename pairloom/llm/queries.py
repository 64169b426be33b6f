"""The operators over the driver's tables, with production parameters, and their SQL checks."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.registry import Query
from pairloom.staging import new_stage, staged

from . import (
    chat,
    decontaminate,
    linededup,
    packing,
    personal,
    quality,
    rollups,
    secrets,
    simhash,
    variants,
    warc,
    weighted,
    whitening,
)
from .common import small

#: Vocabularies of the installed package; every operator takes a path.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def _listed(spans):
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


#: Windows of each item: 13 words, or the whole item if it has fewer.
OP4_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
gram AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)),
met AS (SELECT doc_id, item_id, i, n FROM gram JOIN win USING (n, g)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM met) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@_query(OP4_SQL)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    machine = quality.train(docs, _table(spark, sf_dir, "labels"))
    scores = quality.scored(docs, machine, doc_id=F.col("doc_id"))
    return scores.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.GOOD).cast("int").alias("predicted"),
    )


@_query()
def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), WORD_BPE)


@_query()
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    turns = chat.format_turns(rows.unionByName(more), BYTE_RANKS, public_tokenizers.PATTERN)
    return chat.digests(turns, BYTE_RANKS, public_tokenizers.PATTERN)


#: All pairs of distinct word sets of near sizes: for small tables.
OP6_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL)),
cut AS (
  SELECT doc_id, i, line, doc_id * 10000000::HUGEINT + i AS place,
         list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '[ \t\x0B\f\r]+'), lambda x: x <> ''))) AS s
  FROM line),
sets AS (SELECT s, len(s) AS n, min(place) AS first FROM cut WHERE len(s) > 0 GROUP BY s),
least_place AS (
  SELECT x.s, min(y.first) AS limit_place
  FROM sets x JOIN sets y ON 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n
   AND 9 * len(list_intersect(x.s, y.s)) >= 4 * (x.n + y.n)
  GROUP BY x.s),
kept AS (
  SELECT cut.*, len(cut.s) > 0 AND place > limit_place AS gone FROM cut LEFT JOIN least_place USING (s)),
built AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT coalesce(gone, false)) AS text,
         count(*) FILTER (WHERE coalesce(gone, false)) AS removed_lines
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(b.text, '') END AS text,
       coalesce(removed_lines, 0)::BIGINT AS removed_lines
FROM documents d LEFT JOIN built b USING (doc_id)
"""


@_query(OP6_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, count_col="removed_lines")


@_query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@_query()
def op9_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weighted.beside_next(_table(spark, sf_dir, "documents"))
    hexed = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(hexed)


#: Five hex digits are four base-32 digits.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * k + 1}, 5))::INT >> {s}) & 31) + 1, 1)"
    for k in range(8)
    for s in (15, 10, 5, 0)
)
OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (html)
"""


@_query(OP3_SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_stage(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# The base rules, as this SQL needs them. Longer runs alone are whole matches.
_OP2_RULES = [
    (
        0,
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    (1, "access", "AKIA[A-Z0-9]+", 0, 16),
    (2, "hex", "[0-9a-f]{32,}", 0, 32),
]
_OP2_RULES += [(k, r.kind, r.pattern, 0, 1) for k, r in enumerate(secrets.TOKEN_RULES, 3)]
_OP2_FOUND = "\nUNION ALL\n".join(
    f"""SELECT doc_id, {k} AS k, '{kind}' AS kind, {least} AS least,
  list_transform(string_split_regex(t, '{pattern.replace("'", "''")}'), lambda x: length(x)) AS gaps,
  list_transform(regexp_extract_all(t, '{pattern.replace("'", "''")}', 0), lambda x: length(x)) AS sizes,
  list_transform(regexp_extract_all(t, '{pattern.replace("'", "''")}', {group}), lambda x: length(x)) AS held
FROM texts"""
    for k, kind, pattern, group, least in _OP2_RULES
)
OP2_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_OP2_FOUND}),
spans AS (
  SELECT doc_id, k, kind, list_sum(gaps[1:i])::BIGINT + coalesce(list_sum(sizes[1:i - 1]), 0)::BIGINT AS s, sizes[i] AS size
  FROM (SELECT *, unnest(range(1, len(sizes) + 1)) AS i FROM found) WHERE held[i] >= least),
named AS (SELECT *, kind || ':' || s || ':' || (s + size) AS span FROM spans),
grouped AS (
  SELECT doc_id, string_agg(span, ',' ORDER BY s, k) AS spans, count(*) FILTER (WHERE k = 0) AS n_assign,
         count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
         string_agg(span, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base
  FROM named GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN grouped USING (doc_id)
"""


@_query(OP2_SQL)
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secrets.BASE_RULES]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *map(count, kinds),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


@_query()
def op8_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after loading all documents and a review by the labels: toxic ones deleted, poor ones cut by half."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = _table(spark, sf_dir, "labels").filter("toxic = 1 OR quality = 0")
    reviewed = staged(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "reviewed")
    store = rollups.RollupStore(spark, new_stage(spark, "rollups"), {"word_bpe_49k": WORD_BPE})
    seq = F.lit(0).cast("bigint").alias("seq")
    store.apply("load", docs.select(F.lit("insert").alias("op"), seq, "*"))
    review = docs.join(small(reviewed, 32), "doc_id").select(
        F.when(F.col("toxic") == 1, "delete").otherwise("revise").alias("op"),
        seq,
        "doc_id",
        "source",
        "lang",
        F.expr("left(text, char_length(text) div 2)").alias("text"),
    )
    store.apply("review", review)
    store.apply("review", review)  # comes twice, counts once
    return store.totals()


@_query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))  # null past a long


_CRC_BIT = "xor({0} >> 1, ({0} & 1) * 3988292384::BIGINT)"
_CRC_BYTE = "i"
for _ in range(8):
    _CRC_BYTE = f"list_transform([{_CRC_BYTE}], lambda b: {_CRC_BIT.format('b')})[1]"
#: Skips and halves as strings; the checksum by a table made here.
OP13_SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: {_CRC_BYTE}) AS t),
runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= 7),
keyed AS (SELECT w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM runs GROUP BY doc_id, w),
hashed AS (
  SELECT w, n, xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM keyed, crc),
said AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM said WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less, substr(word, 1, i) || '*' || substr(word, i + 2) AS hole
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
longer AS (SELECT DISTINCT cut.word AS long, cut.n AS long_n, words.word AS short, words.n AS short_n FROM cut JOIN words ON cut.less = words.word),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.hole = b.hole AND a.word <> b.word
  UNION ALL SELECT long, long_n, short, short_n FROM longer
  UNION ALL SELECT short, short_n, long, long_n FROM longer),
best AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
  FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
         CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON w.word = b.word),
up AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT up.word, formed.form FROM up JOIN formed ON formed.word = up.root WHERE formed.form IS NOT NULL)
SELECT formed.word, formed.form, up.root, formed.n, formed.n_near::BIGINT AS n_near, formed.form_n
FROM formed JOIN up ON up.word = formed.word JOIN formed top ON top.word = up.root AND top.form IS NULL
"""


@_query(OP13_SQL)
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's slips: a run loses a letter where 31 divides its hash."""
    words = variants.word_counts(_table(spark, sf_dir, "documents"), slip_every=31)
    return variants.group_variants(staged(words, "words")).select("word", "form", "root", "n", "n_near", "form_n")


@_query()
def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = personal.train(personal.labelled_table(spark))
    found = personal.find_personal(_table(spark, sf_dir, "documents"), chain, doc_id=F.col("doc_id"))
    base = F.filter("spans", lambda s: s["kind"].isin(*personal.BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, personal.BASE_KINDS),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )

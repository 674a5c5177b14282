"""The operators of this folder as registered queries, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import (
    alignment,
    decontamination,
    exact_dedup,
    jaccard_join,
    line_dedup,
    packing,
    sharding,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from earshot.llm.common import documents, numbered

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


def _lines_removed(kept: DataFrame) -> DataFrame:
    spans = F.transform("removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return kept.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        (F.col("n_chars") - F.length("text")).cast("long").alias("removed_chars"),
        F.array_join(spans, ",").alias("removed_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated sentences removed from every document, with their places."""
    return _lines_removed(substring_dedup.remove_repeats(documents(spark, sf_dir)))


@query
def op1_substring_dedup_every_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every repeated sentence, however short and alone."""
    return _lines_removed(substring_dedup.remove_repeats(documents(spark, sf_dir), min_run=0))


@query
def op1_substring_dedup_every_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for all lines that are not blank, however short."""
    lines = substring_dedup.LINES
    return _lines_removed(substring_dedup.remove_repeats(documents(spark, sf_dir), lines, min_run=0))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = _LOWER.format(r"trim(regexp_replace(piece, '[\x20\x09-\x0D]+', ' ', 'g'))")


def _units_sql(pieces: str, gone: str) -> str:
    return rf"""
WITH pieces AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS piece
  FROM (SELECT doc_id, {pieces} AS parts FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))
), placed AS (
  SELECT *, {_NORMAL} AS unit,
         coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM pieces
), ranked AS (
  SELECT *, unit <> '' AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, pos) > 1 AS later,
         greatest(len(string_split(unit, ' ')), length(unit) // 8) AS words,
         count(*) FILTER (unit <> '') OVER (PARTITION BY doc_id ORDER BY pos) AS place
  FROM placed
), islands AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id, later ORDER BY pos) AS island FROM ranked
), judged AS (
  SELECT *, later AND ({gone}) AS gone FROM islands
)
SELECT documents.doc_id,
       count(*) FILTER (gone) AS n_removed,
       coalesce(sum(length(piece)) FILTER (gone), 0)::BIGINT AS removed_chars,
       coalesce(string_agg(start::BIGINT || '-' || (start + length(piece))::BIGINT, ',' ORDER BY pos) FILTER (gone), '')
         AS removed_spans,
       sha256(coalesce(string_agg(piece, '' ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM documents LEFT JOIN judged ON documents.doc_id = judged.doc_id GROUP BY documents.doc_id
"""


_SENTENCES = r"regexp_extract_all(text, '[^\n.!?。！？]*(?:[.!?。！？]+|\n|\z)[\x20\x09-\x0D]*')"
ORACLE["op1_substring_dedup"] = _units_sql(_SENTENCES, "sum(words) OVER (PARTITION BY doc_id, later, island) >= 20")
ORACLE["op1_substring_dedup_every_sentence"] = _units_sql(_SENTENCES, "true")
ORACLE["op1_substring_dedup_every_line"] = _units_sql(r"regexp_extract_all(text, '[^\n]*(?:\n|\z)')", "true")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_documents(documents(spark, sf_dir), labels)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word pieces of every document by greedy longest match over a public vocabulary."""
    import public_tokenizers

    pieces = token_counts.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts.count_pieces(documents(spark, sf_dir), token_counts.build(pieces))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back from the archives."""
    path = warc.archive_path(spark)
    index = warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, min_bytes=0)
    return warc.read_records(index, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# Base32 from hexadecimal: five hex digits are four characters.
ORACLE["op4_warc"] = """
WITH keyed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, i * 5 + 1, 5))::INTEGER >> s) & 31) + 1)::BIGINT, 1)
         ), '')), '') AS payload_digest
  FROM keyed
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM grouped
"""


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that are covered by a 100-byte string met earlier."""
    docs = documents(spark, sf_dir)
    changed = suffix_dedup.remove_repeats(docs).select(
        "_row",
        F.size("spans").cast("long").alias("spans"),
        F.octet_length("kept").cast("long").alias("bytes"),
        F.sha2("kept", 256).alias("sha"),
    )
    every = numbered(docs).select(
        "doc_id", "_row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha")
    )
    return every.join(changed, "_row", "left").select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.coalesce("bytes", "n_bytes")).alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha", "text_sha").alias("kept_sha256"),
    )


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that stand in it."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontamination.mark_contaminated(documents(spark, sf_dir), items)
    listed = F.array_join(F.transform("item_ids", lambda i: i.cast("string")), ",")
    return marked.select("doc_id", "contaminated", "n_items", listed.alias("item_ids"), "n_edits")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of at most 4096."""
    import zlib

    import public_tokenizers

    pieces = packing.pack(
        documents(spark, sf_dir),
        public_tokenizers.path("word_bpe_49k.json"),
        payload=lambda ids: zlib.crc32(ids).to_bytes(4, "big"),
    )
    crc = F.conv(F.hex("payload"), 16, 10).cast("long")
    return pieces.select(
        "doc_id", "start", "length", crc.alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document of equal text that stays."""
    return exact_dedup.exact_groups(documents(spark, sf_dir))


ORACLE["op8_exact_dedup"] = r"""
WITH keyed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM keyed WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in random order over 24 shards, read back from the shards."""
    shards = sharding.shard_documents(documents(spark, sf_dir), shards=24)
    return shards.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest document that links of similar shingle sets reach."""
    return jaccard_join.similarity_classes(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two public tokenizers, aligned."""
    import public_tokenizers

    aligned = alignment.align(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return aligned.drop("pairs", "times")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with the more frequent word one edit away that it is a variant of."""
    return spelling.spelling_variants(documents(spark, sf_dir), slips=97)


# The checksum of a word is taken byte by byte over its hexadecimal form; words one edit
# apart are equal without one letter, or one is the other without a letter.
ORACLE["op12_spelling_variants"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(value ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n::UBIGINT, [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END) AS value
    FROM range(256) AS numbers(n))
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  GROUP BY ALL
), summed AS (
  SELECT run, times, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
           range(1, length(code), 2), lambda i: ('0x' || substr(code, i, 2))::UBIGINT)),
           lambda c, b: xor(t[(xor(c, b) & 255)::BIGINT + 1], c >> 8))) AS h
  FROM (SELECT run, times, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS code FROM runs), crc_table
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 97 = 0
      THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM summed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cuts.word, words.word FROM cuts JOIN words ON cuts.rest = words.word
  UNION SELECT words.word, cuts.word FROM cuts JOIN words ON cuts.rest = words.word
), best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY w.n DESC, other) AS other, max(w.n) AS other_n
  FROM near JOIN words w ON near.other = w.word GROUP BY near.word
), judged AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 2 * words.n THEN other END AS form, CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS place, 0 AS steps FROM judged
  UNION ALL
  SELECT chain.word, judged.form, steps + 1 FROM chain JOIN judged ON place = judged.word WHERE judged.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(place, steps) AS root FROM chain GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)
"""


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that at least four others hold, too, but for the last of them."""
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op13_line_dedup"] = r"""
WITH whole AS (
  SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT place, doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT place, doc_id, string_split(text, chr(10)) AS parts FROM whole)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS keep_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT keyed.*, coalesce(doc_id <> keep_doc, false) AS gone FROM keyed LEFT JOIN frequent USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY place, doc_id
"""

"""The transcript lake: scans and sinks of transcripts, segments and summaries.

Files are JSON lines below ``podcast_id=…/episode_id=…`` folders, the ids only in
the folder names. One folder per episode does not scale: folders others fill are listed
without looking for partitions, ``pack_files`` turns them into few large files once, and our
own datasets are Parquet in key buckets (``keyed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.grouping import ordered_concat
from earshot.functions.once import compute_once, let
from earshot.functions.text import SPACE, is_missing, strip
from earshot.schemas import PARTITION_KEYS, SEGMENT_RECORD, SUMMARY_RECORD, TRANSCRIPT_RECORD
from earshot.sources import keyed
from earshot.sources.tables import path_exists

KEYS = ["podcast_id", "episode_id"]


def _with_keys(record: T.StructType) -> T.StructType:
    return T.StructType([*record.fields, *PARTITION_KEYS.fields])


def _folder_key(name: str) -> Column:
    """Value of ``name=…`` in a file's path, as text.

    The path is encoded once as an address and once as a folder name; a plus sign stands for itself.
    """
    decode = lambda text: F.url_decode(F.regexp_replace(text, r"\+", "%2B"))
    value = decode(decode(F.regexp_extract(F.col("_metadata.file_path"), rf"/{name}=([^/]*)/", 1)))
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", value).alias(name)


def _loose(reader, path: str, *columns: Column) -> DataFrame:
    """Files below ``path`` with their keys: one listing, no partition per episode."""
    found = reader.option("recursiveFileLookup", "true").load(path)
    return found.select(*[_folder_key(k) for k in KEYS], *columns)


def _whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, loose or packed: keys, ``file_name``, ``body``."""
    if keyed.bucket_count(spark, path) is not None:
        return keyed.read(spark, path)
    reader = spark.read.format("text").schema("body string").option("wholetext", "true")
    return _loose(reader, path, F.col("_metadata.file_name").alias("file_name"), F.col("body"))


def store_files(files: DataFrame, path: str) -> keyed.Written:
    """Store whole files (keys, ``file_name``, ``body``) many to a Parquet file; episodes met again are replaced."""
    return keyed.replace(files.select(*KEYS, "file_name", "body"), path, KEYS, "file_name")


def pack_files(spark: SparkSession, path: str, packed: str) -> keyed.Written:
    """Bring a folder with a file per episode into few large files, which every reader here takes instead."""
    return store_files(_whole_files(spark, path), packed)


def _records(line: Column, record: T.StructType, mode: str) -> Column:
    """The JSON objects of a line. Read as a list, so that text behind an object is an error."""
    listed = F.concat(F.lit("["), line, F.lit("]"))
    return F.from_json(listed, T.ArrayType(record), {"mode": mode})


def _line_texts(body: Column, policy: str) -> Column:
    """Array of the texts of a JSON-lines file, in line order.

    A malformed line fails the job under both policies.
    """
    lines = F.split(strip(body), "\n")
    malformed = F.raise_error(F.lit("malformed transcript line")).cast("string")
    one_record = lambda found: F.when(
        (F.size(found) == 1) & F.get(found, F.lit(0)).isNotNull(), F.get(found, F.lit(0))["transcript_text"]
    ).otherwise(malformed)
    parse = lambda line: let(_records(line, TRANSCRIPT_RECORD, "FAILFAST"), one_record)
    blank = rf"(?U)\A{SPACE}*\z"
    if policy == "strict":
        # Blank lines and lines without text are passed over.
        texts = F.transform(F.filter(lines, lambda line: ~line.rlike(blank)), parse)
        return F.filter(texts, lambda text: ~is_missing(text))
    if policy == "keep_empty":
        # Only an empty line is passed over; a line of blanks is malformed.
        return F.transform(
            F.filter(lines, lambda line: line != ""),
            lambda line: F.when(line.rlike(blank), malformed).otherwise(
                F.coalesce(parse(line), F.lit(""))
            ),
        )
    raise ValueError(f"unknown policy {policy!r}")


def read_transcript_lines(spark: SparkSession, path: str, policy: str = "strict") -> DataFrame:
    """Text lines of the transcripts: keys, ``pos`` (order inside the file), ``text``."""
    files = _whole_files(spark, path)
    return files.select(*KEYS, F.posexplode(_line_texts(F.col("body"), policy)).alias("pos", "text"))


def assemble_transcripts(lines: DataFrame) -> DataFrame:
    """Line texts of an episode joined by one blank, in line order."""
    return ordered_concat(lines, KEYS, "pos", "text", " ", "transcript_text")


def read_transcripts(
    spark: SparkSession, path: str, policy: str = "strict", format: str = "jsonl", textless: str = "fail"
) -> DataFrame:
    """One row per file: ``podcast_id``, ``episode_id``, ``transcript_text``.

    ``strict`` drops lines without text and fails on a file that has none, or with
    ``textless="leave_out"`` goes on without that file;
    ``keep_empty`` keeps them as ``''``. ``format="auto"`` goes by suffix: JSON
    files are read with ``keep_empty``, any other file is one plain text. A file
    is one row already, so its lines are joined in place without a shuffle.
    """
    files = _whole_files(spark, path)
    if format == "auto":
        is_lines = F.col("file_name").rlike(r"\.jsonl?(\.[a-z0-9]+)?$")
        joined = F.array_join(_line_texts(F.col("body"), "keep_empty"), " ")
        text = F.when(is_lines, joined).otherwise(F.col("body"))
        return files.select(*KEYS, text.alias("transcript_text"))
    if format != "jsonl":
        raise ValueError(f"unknown format {format!r}")
    if textless not in ("fail", "leave_out"):
        raise ValueError(f"unknown way with files without text {textless!r}")
    texts = _line_texts(F.col("body"), policy)
    text = F.array_join("texts", " ")
    if policy == "strict" and textless == "leave_out":
        read = compute_once(files.select(*KEYS, "body"), {"texts": texts})
        has_text = F.coalesce(F.size("texts") > 0, F.lit(True))
        return read.filter(has_text).select(*KEYS, text.alias("transcript_text"))
    read = files.select(*KEYS, texts.alias("texts"))
    if policy == "strict":
        complaint = F.concat(F.lit("no transcript text for episode "), F.col("episode_id"))
        text = F.when(F.size("texts") == 0, F.raise_error(complaint).cast("string")).otherwise(text)
    return read.select(*KEYS, text.alias("transcript_text"))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segment records with their string keys; lines that are no JSON object are dropped.

    A folder that does not exist yet has no segments.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], _with_keys(SEGMENT_RECORD))
    if keyed.bucket_count(spark, path) is not None:
        lines = keyed.read(spark, path).select(*KEYS, F.explode(F.split("body", "\r\n|\r|\n")).alias("line"))
    else:
        lines = _loose(spark.read.format("text").schema("line string"), path, F.col("line"))
    found = lines.select(*KEYS, _records(F.col("line"), SEGMENT_RECORD, "PERMISSIVE").alias("found"))
    record = F.get("found", F.lit(0))
    return found.filter((F.size("found") == 1) & record.isNotNull()).select(
        *[record[name].alias(name) for name in SEGMENT_RECORD.fieldNames()], *KEYS
    )


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Summary records with their string keys."""
    columns = [*SUMMARY_RECORD.fieldNames(), *KEYS]
    if keyed.bucket_count(spark, path) is not None:
        return keyed.read(spark, path).select(*columns)
    fields = [F.col(name) for name in SUMMARY_RECORD.fieldNames()]
    return _loose(spark.read.format("json").schema(SUMMARY_RECORD), path, *fields).select(*columns)


def write_partitioned(
    df: DataFrame, path: str, layout: str = "parquet", order: str | None = None, buckets: int | None = None
) -> keyed.Written | None:
    """Store transcripts or segments in place of all that stood there.

    ``parquet`` deals them over key buckets, as many as their size asks for unless told, sorted so that
    row-group statistics prune lookups. ``jsonl`` is the exchange layout: ids only in the
    folder names, one writer per episode, records in ``order`` inside the file;
    it replaces the episodes written and no others.
    """
    if layout == "parquet":
        return keyed.store(df, path, KEYS, order, buckets)
    if layout != "jsonl":
        raise ValueError(f"unknown layout {layout!r}")
    return _write_json(df, path, order)


def replace_episodes(df: DataFrame, path: str, order: str | None = None) -> keyed.Written:
    """Store episodes in the Parquet layout; one that is stored already is replaced, as when it is transcribed again."""
    return keyed.replace(df, path, KEYS, order)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the Parquet layout, without the bucket."""
    return keyed.read(spark, path)


def read_episodes(asked: DataFrame, path: str) -> DataFrame:
    """Rows of the Parquet layout from the buckets in which the asked episodes lie."""
    return keyed.read_buckets_of(asked, path, KEYS)


def bucket_filter(podcast_id: str, episode_id: str) -> Column:
    """Predicate for one key that lets a scan of the Parquet layout open one bucket only."""
    key = F.pmod(F.xxhash64(F.lit(podcast_id), F.lit(episode_id)), F.col("buckets")).cast("int")
    return (
        (F.col("bucket") == key)
        & (F.col("podcast_id") == podcast_id)
        & (F.col("episode_id") == episode_id)
    )


def _write_json(df: DataFrame, path: str, order: str | None = None) -> None:
    """JSON lines below the key folders; only the folders written to are replaced.

    The number of writers is given, because small data in many folders would
    otherwise be coalesced into one writer.
    """
    writers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartition(writers, *KEYS)
    if order is not None:
        spread = spread.sortWithinPartitions(*KEYS, order).drop(order)
    (
        spread.write.partitionBy(*KEYS)
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .mode("overwrite")
        .json(path)
    )


def write_summaries(analysis: DataFrame, path: str, layout: str = "parquet") -> keyed.Written | None:
    """Store summaries with their defaults; only the written episodes are replaced."""
    nothing = F.array().cast("array<string>")
    records = analysis.select(
        *[F.col(k).cast("string").alias(k) for k in KEYS],
        F.coalesce("summary", F.lit("")).alias("summary"),
        F.coalesce("topics", nothing).alias("topics"),
        F.coalesce("speakers", nothing).alias("speakers"),
    )
    return replace_episodes(records, path) if layout == "parquet" else _write_json(records, path)


DATASETS = {
    "transcripts": TRANSCRIPT_RECORD,
    "segments": SEGMENT_RECORD,
    "summaries": SUMMARY_RECORD,
}


def register(spark: SparkSession, table: str, written: keyed.Written) -> str:
    """Bring a catalog table up to what a writer reports: its columns, and the buckets it wrote.

    The table is declared once. Columns it lacks are added, the written buckets become its
    partitions; no folder is listed and no file touched. A dataset that was dealt over more
    buckets lies in another folder, so its table is declared anew.
    """
    known = spark.catalog.tableExists(table)
    if known:
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").head()
        if details is None or details["data_type"].rstrip("/").rsplit("/", 2)[-2:] != written.folder.rsplit("/", 2)[-2:]:
            spark.sql(f"DROP TABLE {table}")
            known = False
    named = lambda fields: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if not known:
        spark.sql(
            f"CREATE TABLE {table} ({named(written.columns.fields)}, bucket INT) USING parquet "
            f"PARTITIONED BY (bucket) LOCATION '{written.folder}'"
        )
    else:
        held = set(spark.table(table).columns)
        added = [f for f in written.columns.fields if f.name not in held]
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({named(added)})")
    for first in range(0, len(written.written), 1000):
        parts = " ".join(f"PARTITION (bucket = {b})" for b in written.written[first : first + 1000])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(table)
    return table


def register_datasets(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Make the datasets below ``root`` queryable as external tables, as they stand now.

    For datasets that others wrote; a job that writes passes its report to ``register``. A dataset without a folder
    is passed over until it has one.
    """
    names = []
    for name in DATASETS:
        path = f"{root}/{name}"
        buckets = keyed.bucket_count(spark, path)
        if buckets is not None:
            columns = keyed.read(spark, path).schema
            report = keyed.Written(f"{path}/buckets={buckets}", buckets, list(range(buckets)), columns)
            names.append(register(spark, f"{prefix}{name}", report))
    return names

"""Every operator as a query over the given tables.

Each query takes ``(spark, sf_dir)`` and gives a DataFrame. Hashed ids are left
out of the results in favour of the natural keys they stand for.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.dates import iso_date, mail_date
from earshot.functions.grouping import ordered_concat
from earshot.functions.text import sentence_start
from earshot.operators import analysis, analytics, context, embedding, ingest, keywords, quantised, search, transcription
from earshot.plans import jobs
from earshot.plans.binding import Domain
from earshot.schemas import TABLES
from earshot.session import fixed, scratch_path
from earshot.sources import feeds, keyed, lake, lookups, tables
from earshot.streaming import ingest_stream as streaming

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    """Register a query under the name of the function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Domain(spark, sf_dir))

    REGISTRY[build.__name__] = run
    return build


def _score(col: str, name: str) -> Column:
    return F.round(col, 6).alias(name)


def _flag(df: DataFrame) -> DataFrame:
    """The three-valued flag as text."""
    return df.withColumn("transcribed", F.col("transcribed").cast("string"))


def _list(col: str) -> Column:
    return F.array_join(col, "|").alias(col)


# -- sources and sinks ---------------------------------------------------------


@query
def list_podcasts(d: Domain) -> DataFrame:
    return tables.list_podcasts(d.podcasts)


def _json_lines(text: str) -> Column:
    """A text's lines as the lines of a JSON-lines file."""
    records = F.transform(F.split(text, "\n"), lambda line: F.to_json(F.struct(line.alias("transcript_text"))))
    return F.array_join(records, "\n")


def _land(d: Domain, name: str, bodies: DataFrame, file_name: str = "data.jsonl") -> str:
    """Files of the lake, packed; their loose form would be a folder per episode."""
    path = scratch_path(d.spark, name)
    lake.store_files(bodies.select("podcast_id", "episode_id", F.lit(file_name).alias("file_name"), "body"), path)
    return path


@query
def transcripts_strict(d: Domain) -> DataFrame:
    """Episodes with text; one without any must not cost the others theirs."""
    path = _land(d, "strict", d.transcripts.withColumn("body", _json_lines("transcript_text")))
    return lake.read_transcripts(d.spark, path, "strict", textless="leave_out")


@query
def transcripts_keep_empty(d: Domain) -> DataFrame:
    path = _land(d, "keep-empty", d.transcripts.withColumn("body", _json_lines("transcript_text")))
    return lake.read_transcripts(d.spark, path, "keep_empty")


@query
def transcripts_any_format(d: Domain) -> DataFrame:
    """Plain-text files next to JSON-lines files."""
    plain = d.transcripts.withColumn("body", F.concat("transcript_text", F.lit("\n")))
    lined = d.transcripts.select(
        F.concat("podcast_id", F.lit("-lines")).alias("podcast_id"), "episode_id",
        F.to_json(F.struct("transcript_text")).alias("body"),
    )
    both = [_land(d, "any", plain, "transcript.txt"), _land(d, "any-json", lined)]
    parts = [lake.read_transcripts(d.spark, p, format="auto") for p in both]
    return parts[0].unionByName(parts[1])


@query
def assemble_transcripts(d: Domain) -> DataFrame:
    lines = d.turns.select(F.lit("show").alias("podcast_id"), "episode_id", "pos", "text")
    return lake.assemble_transcripts(lines).select("episode_id", "transcript_text")


@query
def segments_tolerant(d: Domain) -> DataFrame:
    record = F.to_json(F.struct("start_time", "end_time", "speaker", "text"))
    body = F.when(F.col("speaker") == "system", F.concat(F.lit('{"broken'), record)).otherwise(record)
    rows = d.turns.select(F.lit("show").alias("podcast_id"), F.col("episode_id").cast("string").alias("episode_id"), "pos", body.alias("line"))
    files = ordered_concat(rows, lake.KEYS, "pos", "line", "\n", "body")
    return lake.read_segments(d.spark, _land(d, "segments", files)).select(
        F.col("episode_id").cast("bigint").alias("episode_id"), "start_time", "end_time", "speaker", "text"
    )


@query
def stored_transcripts(d: Domain) -> DataFrame:
    """Stored twice: the second time half of the episodes come again and take the place of the first ones."""
    path = scratch_path(d.spark, "transcripts")
    first = F.when(F.col("episode_id").cast("bigint") % 2 == 1, "older").otherwise(F.col("transcript_text"))
    lake.write_partitioned(d.transcripts.withColumn("transcript_text", first), path)
    lake.replace_episodes(d.transcripts.filter("CAST(episode_id AS BIGINT) % 2 = 1"), path)
    return lake.read_partitioned(d.spark, path)


@query
def stored_summaries(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "summaries")
    lake.write_summaries(d.summaries, path)
    return lake.read_summaries(d.spark, path).select(
        "podcast_id", "episode_id", "summary", _list("topics"), _list("speakers")
    )


@query
def transcript_coverage(d: Domain) -> DataFrame:
    return lookups.transcript_coverage(d.episodes.select("episode_id"), d.transcripts)


@query
def registered_datasets(d: Domain) -> DataFrame:
    """Rows and text sizes of the three datasets, read as catalog tables that follow their writers' reports."""
    root = scratch_path(d.spark, "lake")
    prefix = "lake_" + root.rsplit("-", 1)[1] + "_"
    turns = d.turns.withColumn("podcast_id", F.lit("show")).withColumn("episode_id", F.col("episode_id").cast("string"))
    segments = turns.select("podcast_id", "episode_id", "pos", "start_time", "end_time", "speaker", "text")
    lines = fixed(lake.assemble_transcripts(turns.select("podcast_id", "episode_id", "pos", "text")))
    summary = lines.select(
        "podcast_id", "episode_id", F.col("transcript_text").alias("summary"),
        F.array(F.lit("talk")).alias("topics"), F.lit(None).cast("array<string>").alias("speakers"),
    )
    # The first report declares a table without the text, the second one adds it.
    early = lake.write_partitioned(lines.filter("CAST(episode_id AS BIGINT) % 2 = 0").drop("transcript_text"), f"{root}/transcripts")
    lake.register(d.spark, f"{prefix}transcripts", early)
    written = [
        ("transcripts", "transcript_text", lake.replace_episodes(lines, f"{root}/transcripts")),
        ("segments", "text", lake.write_partitioned(segments, f"{root}/segments", order="pos")),
        ("summaries", "summary", lake.write_summaries(summary, f"{root}/summaries")),
    ]
    parts = []
    for name, text, report in written:
        table = lake.register(d.spark, f"{prefix}{name}", report)
        parts.append(
            d.spark.table(table).groupBy("podcast_id").agg(
                F.lit(name).alias("dataset"),
                F.count("*").alias("rows"),
                F.count_distinct("episode_id").alias("episodes"),
                F.sum(F.length(text)).alias("characters"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _asked_keys(d: Domain) -> DataFrame:
    """Keys of labelled documents; some name a podcast the episode does not belong to."""
    return d.raw("labels").selectExpr(
        "concat('src', CASE WHEN toxic = 1 THEN 'x' ELSE CAST(doc_id % 20 AS STRING) END) AS podcast_id", "doc_id AS episode_id"
    )


@query
def lookup_transcripts(d: Domain) -> DataFrame:
    short = F.length("transcript_text") < 500
    stored = d.transcripts.withColumn("transcript_text", F.when(short, "").otherwise(F.col("transcript_text")))
    path = lake.write_partitioned(stored, scratch_path(d.spark, "transcripts")).folder.rsplit("/", 1)[0]
    asked = _asked_keys(d)
    return lookups.lookup_transcripts(asked, lake.read_episodes(asked, path))


@query
def lookup_summaries(d: Domain) -> DataFrame:
    path = lake.write_partitioned(d.summaries, scratch_path(d.spark, "summaries")).folder.rsplit("/", 1)[0]
    asked = _asked_keys(d)
    return lookups.lookup_summaries(asked, lake.read_episodes(asked, path)).select(
        "podcast_id", "episode_id", "summary", _list("topics"), _list("speakers"), "status"
    )


# -- ingestion -----------------------------------------------------------------


@query
def parse_feed_headers(d: Domain) -> DataFrame:
    own = F.filter("links", lambda l: l["rel"] == "self")
    return feeds.parse_feed_headers(d.feed_documents).select(
        "url", "title", "published", "language", "link", "new_feed_url",
        F.get(own, F.lit(0))["href"].alias("self_href"), F.size("links").alias("links"),
    )


@query
def parse_feed_entries(d: Domain) -> DataFrame:
    audio = F.filter("links", lambda l: l["rel"] == "enclosure")
    return feeds.parse_feed_entries(d.feed_documents).select(
        "url", "feed_pos", "title", "link", "published", F.get(audio, F.lit(0))["href"].alias("audio_href"),
    )


@query
def parse_mixed_feeds(d: Domain) -> DataFrame:
    """Entries of RSS and Atom documents with mail and ISO dates."""
    known = d.mixed_documents.select(
        F.lit(1).cast("long").alias("podcast_id"), F.lit("any").alias("podcast_name"), F.col("url").alias("podcast_url")
    )
    landed = d.mixed_documents.withColumn("fetched_at", F.lit("2025-01-01").cast("timestamp_ntz"))
    return ingest.landed_entries(landed, known).select(
        F.col("podcast_url").alias("url"), "feed_pos", "title", "link",
        ingest.entry_date().alias("published_at"), ingest.audio_url().alias("audio_url"),
    )


@query
def gate_feed_urls(d: Domain) -> DataFrame:
    return ingest.gate_feed_urls(d.raw("pages").select("page_id", "url")).unionByName(
        ingest.gate_feed_urls(d.podcasts.selectExpr("-1 - podcast_id AS page_id", "podcast_url AS url"))
    )


@query
def validate_feeds(d: Domain) -> DataFrame:
    return ingest.validate_feeds(d.feeds)[0]


@query
def rejected_feeds(d: Domain) -> DataFrame:
    return ingest.validate_feeds(d.feeds)[1].select("row_id", "reject_reason")


def _known_feeds(d: Domain) -> DataFrame:
    """Podcast table to load into: some announced addresses are known already."""
    return d.raw("customer").filter("c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 4000").selectExpr(
        "c_custkey AS podcast_id", "c_name AS podcast_name", "CAST(NULL AS TIMESTAMP_NTZ) AS publish_date",
        "CAST(c_nationkey AS BIGINT) AS language_id", "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS uploaded_at",
        "concat('https://moved.example/', c_custkey, '.rss') AS podcast_url",
    )


def _upserted(d: Domain):
    return ingest.upsert_podcasts(ingest.validate_feeds(d.feeds)[0], _known_feeds(d), d.languages, "row_id")


@query
def upsert_podcasts(d: Domain) -> DataFrame:
    podcasts, languages, _ = _upserted(d)
    return podcasts.join(languages, "language_id").select(
        "podcast_url", "podcast_name", "publish_date", "language_name"
    )


@query
def upsert_languages(d: Domain) -> DataFrame:
    return _upserted(d)[1].select("language_name")


@query
def upsert_podcast_status(d: Domain) -> DataFrame:
    return _upserted(d)[2]


@query
def ingest_cutoffs(d: Domain) -> DataFrame:
    return ingest.ingest_cutoffs(d.episodes)


@query
def ingest_cutoffs_by_date(d: Domain) -> DataFrame:
    return ingest.ingest_cutoffs(d.episodes, "published_at", "3 days")


def _new(d: Domain) -> DataFrame:
    return ingest.select_new_episodes(d.entries, ingest.ingest_cutoffs(d.loaded))


@query
def select_new_episodes(d: Domain) -> DataFrame:
    return _new(d).select("podcast_id", "feed_pos", ingest.entry_date().alias("published_at"))


@query
def entry_audio_links(d: Domain) -> DataFrame:
    return d.entries.select("podcast_id", "feed_pos", ingest.audio_url().alias("audio_url"))


@query
def validate_episodes(d: Domain) -> DataFrame:
    return ingest.validate_episodes(d.entries)[0].select(
        "podcast_id", "podcast_name", "feed_pos", "episode_title", "audio_url", "published_at", "transcribed"
    )


@query
def rejected_episodes(d: Domain) -> DataFrame:
    return ingest.validate_episodes(d.entries)[1].select("podcast_id", "feed_pos", "reject_reason")


@query
def mail_dates(d: Domain) -> DataFrame:
    return d.entries.select("feed_pos", mail_date(F.col("published")).alias("published_at"))


@query
def iso_dates(d: Domain) -> DataFrame:
    """Times of events as ISO texts in several forms, some without seconds, some that are no dates."""
    minute, second = (F.date_format("ts", f"yyyy-MM-dd'T'HH:mm{rest}") for rest in ("", ":ss"))
    text = (
        F.when(F.col("event_type") == "click", F.concat(minute, F.lit("-0130")))
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), F.translate(minute, "T", " ")))
        .when(F.col("event_type") == "purchase", F.concat(second, F.lit(".250Z")))
        .when(F.col("event_type") == "signup", F.concat(minute, F.lit("Z")))
        .otherwise(F.substring(second, 6, 20))
    )
    return d.raw("events").select("event_id", iso_date(text).alias("published_at"))


@query
def podcasts_with_episodes(d: Domain) -> DataFrame:
    return ingest.podcasts_with_episodes(ingest.validate_episodes(d.entries)[0], d.entries)


def _loaded(d: Domain) -> tuple[DataFrame, DataFrame]:
    # As in the job: the accepted rows serve the insert and the outcomes, and are worked out once.
    accepted = fixed(ingest.validate_episodes(_new(d))[0])
    return ingest.load_episodes(accepted, d.loaded, d.known_podcasts)


@query
def load_episodes(d: Domain) -> DataFrame:
    return _loaded(d)[0].select(
        "podcast_id", "uploaded_at", "audio_url", "transcribed", "published_at", "episode_title"
    )


@query
def load_outcomes(d: Domain) -> DataFrame:
    return _loaded(d)[1].select("podcast_id", "feed_pos", "audio_url", "outcome")


@query
def load_stats(d: Domain) -> DataFrame:
    whole = F.col("podcast_id").isNull()
    return ingest.load_stats(_loaded(d)[1]).withColumns(
        {
            "podcast_id": F.when(whole, -1).otherwise(F.col("podcast_id")),
            "podcast_name": F.when(whole, "all").otherwise(F.col("podcast_name")),
        }
    )


def _streamed(d: Domain, files_per_batch: int) -> DataFrame:
    """The load as a stream over landed files, started twice to show that nothing is loaded again."""
    root = scratch_path(d.spark, "stream")
    d.entries.repartition(6, "feed_pos").write.parquet(f"{root}/landing")
    for _ in range(2):
        running = streaming.ingest_stream(
            d.spark, f"{root}/landing", f"{root}/episodes", f"{root}/progress", d.known_podcasts,
            files_per_batch=files_per_batch,
        )
        running.awaitTermination()
    return streaming.read_target(d.spark, f"{root}/episodes").select(
        "podcast_id", "uploaded_at", "audio_url", "transcribed", "published_at", "episode_title"
    )


@query
def ingest_stream(d: Domain) -> DataFrame:
    return _streamed(d, 1000)


@query
def ingest_stream_by_files(d: Domain) -> DataFrame:
    """The same polls cut over micro-batches of two files."""
    return _streamed(d, 2)


@query
def load_repeated_documents(d: Domain) -> DataFrame:
    """What the job reports and stores when every feed document landed twice."""
    root = scratch_path(d.spark, "repeated")
    landed = fixed(d.feed_documents.select("url", "body"))
    known = {"podcast_id": F.xxhash64("url"), "podcast_name": F.col("url"), "podcast_url": F.col("url")}
    blank = lambda f: F.lit(None).cast(f.dataType)
    podcasts = landed.select(*[known.get(f.name, blank(f)).alias(f.name) for f in TABLES["podcast"].fields])
    tables.publish(d.spark, root, replaced={"podcast": podcasts})
    at = F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00"))
    report = jobs.load_new_episodes(d.spark, root, landed.unionByName(landed), at, first_n=5)
    stored = tables.read_snapshot(d.spark, root, "episode").groupBy("podcast_id").agg(F.count("*").alias("stored"))
    return (
        report.filter("podcast_id IS NOT NULL")
        .join(stored, "podcast_id", "left")
        .select(
            "podcast_name", "total_episodes", "inserted_episodes", "skipped_episodes",
            F.coalesce("stored", F.lit(0)).cast("long").alias("stored"),
        )
    )


@query
def incremental_publish(d: Domain) -> DataFrame:
    """Rows that each step of three loads writes, and what readers of each version see."""
    root = scratch_path(d.spark, "increments")
    parts = [d.episodes.filter("transcribed"), d.episodes.filter("NOT transcribed"), d.episodes.filter("transcribed IS NULL")]
    tables.publish(d.spark, root, replaced={"episode": parts[0], "podcast": d.podcasts})
    for part in parts[1:]:
        tables.publish(d.spark, root, appended={"episode": part})
    parts = None
    for version in (1, 2, 3):
        folder = tables.table_folders(d.spark, root, version)["episode"][-1]
        rows = {
            "written": d.spark.read.parquet(f"{root}/{folder}"),
            "episodes": tables.read_snapshot(d.spark, root, "episode", version),
            "podcasts": tables.read_snapshot(d.spark, root, "podcast", version),
        }
        for name, df in rows.items():
            key = F.col("episode_id") if name == "episodes" else F.lit(None).cast("bigint")
            part = df.select(F.lit(version).alias("version"), F.lit(name).alias("what"), key.alias("key"))
            parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("version").agg(
        *[F.count_if(F.col("what") == name).alias(name) for name in ("written", "episodes", "podcasts")],
        F.sum("key").alias("key_sum"),
    )


@query
def cascade_delete(d: Domain) -> DataFrame:
    """What is left per table after closing the furniture podcasts and dropping some languages."""
    left = ingest.cascade_delete(
        {
            "podcast": d.podcasts, "episode": d.episodes, "language": d.languages,
            "episode_topics": d.episode_topics, "episode_speakers": d.episode_speakers,
            "episode_embedding": d.embeddings,
        },
        podcast_keys=d.podcasts.filter("podcast_name = 'FURNITURE'"),
        language_keys=d.raw("nation").filter("n_regionkey = 2").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS language_id"
        ),
    )
    parts = None
    for name, key in (
        ("podcast", "podcast_id"), ("episode", "episode_id"), ("language", "language_id"),
        ("episode_topics", "episode_id"), ("episode_speakers", "episode_id"), ("episode_embedding", "episode_id"),
    ):
        part = left[name].agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows"), F.sum(key).alias("key_sum")
        )
        parts = part if parts is None else parts.unionByName(part)
    orphans = left["podcast"].agg(
        F.lit("podcast without language").alias("table_name"),
        F.count_if(F.col("language_id").isNull()).alias("rows"),
        F.sum(F.when(F.col("language_id").isNull(), F.col("podcast_id"))).alias("key_sum"),
    )
    return parts.unionByName(orphans)


# -- transcription -------------------------------------------------------------


@query
def backlog_count(d: Domain) -> DataFrame:
    return transcription.backlog_count(d.episodes)


@query
def work_list(d: Domain) -> DataFrame:
    return transcription.work_list(d.episodes, d.podcasts, 100)


@query
def guard_required(d: Domain) -> DataFrame:
    work = d.entries.select(
        F.col("feed_pos").alias("episode_id"), "podcast_name",
        F.col("title").alias("episode_title"), F.coalesce("link", F.lit("")).alias("audio_url"),
    )
    return transcription.guard_required(work).select("episode_id", "status")


@query
def plan_slices(d: Domain) -> DataFrame:
    audio = d.transcripts.select(
        F.col("episode_id").cast("bigint").alias("episode_id"),
        (F.length("transcript_text") * 250).cast("bigint").alias("duration_ms"),
    )
    return transcription.plan_slices(audio)


def _slices(d: Domain) -> DataFrame:
    return d.turns.select(
        "episode_id", F.col("pos").alias("slice_index"), (F.length("text") * F.lit(0.213)).cast("double").alias("duration_s"),
        "text", (F.col("speaker") != "system").alias("ok"),
    )


@query
def stitch_segments(d: Domain) -> DataFrame:
    lines = d.turns.select(
        "episode_id", F.col("pos").alias("slice_index"), "speaker",
        F.posexplode(F.split("text", "\n")).alias("pos", "text"),
    )
    segments = lines.select(
        "episode_id", "slice_index", "pos", "speaker", "text",
        (F.col("pos") * 1.5).cast("double").alias("start_time"),
        (F.col("pos") * 1.5 + 1).cast("double").alias("end_time"),
    )
    return transcription.stitch_segments(_slices(d), segments).withColumns(
        {c: F.round(c, 6) for c in ("start_time", "end_time")}
    )


@query
def assemble_text(d: Domain) -> DataFrame:
    return transcription.assemble_text(_slices(d))


@query
def apply_transcribed(d: Domain) -> DataFrame:
    done = d.transcripts.select(F.col("episode_id").cast("bigint").alias("episode_id"))
    return _flag(transcription.apply_transcribed(d.episodes, done).select("episode_id", "transcribed"))


def _bucket_files(d: Domain, path: str, keys: list[str]) -> DataFrame:
    """The files each bucket of a stored dataset consists of."""
    buckets = keyed.bucket_count(d.spark, path)
    stored = d.spark.read.parquet(f"{path}/buckets={buckets}")
    return stored.groupBy("bucket").agg(F.array_sort(F.collect_set("_metadata.file_path")).alias("files"))


def _replaced(d: Domain, path: str, keys: list[str], new: DataFrame, order: str | None = None) -> DataFrame:
    """The dataset after a replacement; ``as_reported`` tells whether a row's bucket was written exactly if the report says so."""
    before = fixed(_bucket_files(d, path, keys))
    report = keyed.replace(new, path, keys, order)
    after = _bucket_files(d, path, keys).join(before.withColumnRenamed("files", "old_files"), "bucket", "left")
    reported = F.array_contains(F.array(*[F.lit(b) for b in report.written]), F.col("bucket"))
    checked = after.select("bucket", (~F.col("files").eqNullSafe(F.col("old_files")) == reported).alias("as_reported"))
    stored = keyed.read(d.spark, path)
    return stored.withColumn("bucket", keyed.bucket_of(keys, F.lit(report.buckets))).join(checked, "bucket").drop("bucket")


@query
def transcribed_in_buckets(d: Domain) -> DataFrame:
    """The flags of the toxic documents' episodes set in a stored table: other buckets are not written."""
    path = scratch_path(d.spark, "episodes")
    keyed.store(d.episodes, path, ["episode_id"], buckets=64)
    done = d.raw("labels").filter("toxic = 1").selectExpr("doc_id AS episode_id")
    asked = keyed.read_buckets_of(done, path, ["episode_id"]).join(done, "episode_id", "left_semi")
    new = transcription.apply_transcribed(asked, done)
    return _flag(_replaced(d, path, ["episode_id"], new).select("episode_id", "transcribed", "as_reported"))


@query
def embeddings_in_buckets(d: Domain) -> DataFrame:
    """The vectors of the episodes with a toxic document replaced by one chunk each, in place."""
    path = scratch_path(d.spark, "embeddings")
    keyed.store(d.embeddings, path, ["episode_id"], "chunk_index", buckets=64)
    touched = d.raw("labels").filter("toxic = 1").selectExpr("doc_id AS episode_id").join(
        d.embeddings.select("episode_id").distinct(), "episode_id", "left_semi"
    )
    new = touched.select(
        "episode_id", F.lit(0).cast("bigint").alias("chunk_index"), F.lit("new").alias("chunk_text"),
        F.array(F.lit(1.0).cast("float")).alias("transcript_embedding"),
    )
    stored = _replaced(d, path, ["episode_id"], new, "chunk_index")
    return stored.select("episode_id", "chunk_index", "chunk_text", F.size("transcript_embedding").alias("numbers"), "as_reported")


@query
def route_outcomes(d: Domain) -> DataFrame:
    results = d.raw("labels").selectExpr(
        "doc_id AS episode_id",
        "CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN 'success' ELSE 'no_work' END AS status",
    )
    return transcription.outcome_counts(transcription.route_outcomes(results))


# -- analysis ------------------------------------------------------------------


@query
def speaker_samples(d: Domain) -> DataFrame:
    return analysis.speaker_samples(d.turns)


@query
def analysis_requests(d: Domain) -> DataFrame:
    transcripts = d.transcripts.withColumn("episode_id", F.col("episode_id").cast("bigint"))
    return analysis.analysis_requests(transcripts, analysis.speaker_samples(d.turns))


@query
def parse_analysis(d: Domain) -> DataFrame:
    return analysis.parse_analysis(d.responses).select(
        "episode_id", "status", _list("topics"), "summary", _list("speakers")
    )


def _known_topics(d: Domain) -> DataFrame:
    """Topic table to load into: the languages of labelled documents."""
    return (
        d.raw("documents").join(d.raw("labels"), "doc_id", "left_semi").filter("lang <> 'en'")
        .groupBy(F.col("lang").alias("topic_name")).agg(F.min("doc_id").alias("topic_id"))
    )


def _known_speakers(d: Domain) -> DataFrame:
    return (
        d.raw("documents").filter("lang = 'de'")
        .groupBy(F.concat(F.lit("SRC"), F.substring("source", 4, 9)).alias("speaker_name"))
        .agg(F.min("doc_id").alias("speaker_id"))
        .withColumn("speaker_username", F.lit(None).cast("string"))
    )


def _analysis_tables(d: Domain) -> dict[str, DataFrame]:
    return {
        "topics": _known_topics(d),
        "speakers": _known_speakers(d),
        "episode_topics": _known_topics(d).selectExpr("topic_id AS episode_id", "topic_id"),
        "episode_speakers": _known_speakers(d).selectExpr("speaker_id AS episode_id", "speaker_id"),
    }


@query
def upsert_topics(d: Domain) -> DataFrame:
    known = _analysis_tables(d)
    topics, links = analysis.upsert_topics(d.analyses, known["topics"], known["episode_topics"])
    return links.join(topics, "topic_id").select("episode_id", "topic_name")


@query
def upsert_speakers(d: Domain) -> DataFrame:
    known = _analysis_tables(d)
    speakers, links = analysis.upsert_speakers(d.analyses, known["speakers"], known["episode_speakers"])
    return links.join(speakers, "speaker_id").select("episode_id", "speaker_name")


def _stored(d: Domain) -> dict[str, DataFrame]:
    existing = d.episodes.filter("transcribed IS NOT NULL")
    return analysis.store_analysis(d.analyses, existing, _analysis_tables(d))


@query
def analysis_status(d: Domain) -> DataFrame:
    existing = d.episodes.filter("transcribed IS NOT NULL")
    return analysis.analysis_status(d.analyses, existing).select("episode_id", "status")


@query
def store_analysis(d: Domain) -> DataFrame:
    """Links per stored topic and speaker name."""
    stored = _stored(d)
    count = lambda bridge, names, key, name, kind: (
        stored[bridge].join(stored[names], key, "right")
        .groupBy(F.col(name).alias("name")).agg(F.count("episode_id").alias("episodes"))
        .withColumn("kind", F.lit(kind))
    )
    return count("episode_topics", "topics", "topic_id", "topic_name", "topic").unionByName(
        count("episode_speakers", "speakers", "speaker_id", "speaker_name", "speaker")
    )


@query
def episode_analysis(d: Domain) -> DataFrame:
    lists = analysis.episode_analysis(d.episodes, d.topics, d.episode_topics, d.speakers, d.episode_speakers)
    return lists.select("episode_id", _list("topics"), _list("speakers"), "summary")


# -- embedding -----------------------------------------------------------------


@query
def gate_transcripts(d: Domain) -> DataFrame:
    return embedding.gate_transcripts(d.transcripts).select("episode_id", "reject_reason")


def _tokens(d: Domain) -> DataFrame:
    return d.transcripts.select(
        F.col("episode_id").cast("bigint").alias("episode_id"),
        embedding.space_tokens(F.col("transcript_text")).alias("tokens"),
    )


@query
def chunk_transcripts(d: Domain) -> DataFrame:
    return embedding.chunk_transcripts(_tokens(d))[0]


@query
def embed_chunks(d: Domain) -> DataFrame:
    """Size and length of every chunk's vector."""
    chunks, _ = embedding.chunk_transcripts(_tokens(d))
    embedded, _ = embedding.embed_chunks(chunks, embedding.hashing_embedder(1536))
    squares = F.aggregate("transcript_embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    return embedded.select(
        "episode_id", "chunk_index", F.size("transcript_embedding").alias("dimensions"),
        F.round(F.sqrt(squares), 3).alias("length"),
    )


def _letter_counts():
    """A model that counts the letters of a text, and refuses requests in which a text holds a double z."""
    import numpy as np

    def model(texts):
        if any("zz" in text for text in texts):
            raise ValueError("request refused")
        return np.array([[text.count(chr(97 + i)) for i in range(26)] for text in texts], np.float32)

    return model


@query
def embed_batches(d: Domain) -> DataFrame:
    """Chunks through a model that takes batches: products of their vectors, without the episodes it refused."""
    chunks, _ = embedding.chunk_transcripts(_tokens(d))
    embedded, failed = embedding.embed_chunks(chunks, embedding.batch_embedder(_letter_counts, 32))
    numbers = F.transform("transcript_embedding", lambda x: x.cast("bigint"))
    total = lambda weigh: F.aggregate(
        F.transform(numbers, weigh), F.lit(0).cast("bigint"), lambda sum_, x: sum_ + x
    )
    return embedded.select(
        "episode_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), F.size("transcript_embedding").alias("dimensions"),
        total(lambda x, i: x * (i + 1)).alias("weighed"), total(lambda x: x * x).alias("squares"),
        F.lit(None).cast("bigint").alias("failed_chunks"),
    ).unionByName(failed.select(
        "episode_id", *[F.lit(None).cast(t).alias(c) for c, t in (("chunk_index", "bigint"), ("dimensions", "int"), ("weighed", "bigint"), ("squares", "bigint"))],
        "failed_chunks",
    ))


def _defective(d: Domain) -> DataFrame:
    """Embeddings where one label's last chunks lost half their vector and another's have none."""
    vector = F.col("transcript_embedding")
    labelled = d.embeddings.join(
        d.raw("embeddings").selectExpr("vec_id div 5 AS episode_id", "vec_id % 5 AS chunk_index", "label"),
        ["episode_id", "chunk_index"],
    )
    broken = F.when((F.col("label") == 3) & (F.col("chunk_index") == 4), F.slice(vector, 1, 32))
    broken = broken.when((F.col("label") == 5) & (F.col("chunk_index") == 2), F.lit(None)).otherwise(vector)
    return labelled.withColumn("transcript_embedding", broken)


@query
def validate_embeddings(d: Domain) -> DataFrame:
    everyone = d.transcripts.select(F.col("episode_id").cast("bigint").alias("episode_id"))
    return embedding.validate_embeddings(_defective(d), 64, everyone)


@query
def valid_chunks(d: Domain) -> DataFrame:
    chunks = _defective(d)
    return embedding.keep_valid(chunks, embedding.validate_embeddings(chunks, 64)).select(
        "episode_id", "chunk_index", "label"
    )


@query
def replace_embeddings(d: Domain) -> DataFrame:
    chunk = d.raw("embeddings").selectExpr(
        "vec_id div 5 AS episode_id", "vec_id % 5 AS chunk_index", "concat('new ', label) AS chunk_text",
        "embedding AS transcript_embedding", "label",
    )
    existing = d.episodes.filter("transcribed IS NOT NULL")
    table, _ = embedding.replace_embeddings(chunk.filter("label < 3"), d.embeddings, existing)
    return table.select(
        "episode_id", "chunk_index", "chunk_text",
        F.size("transcript_embedding").alias("numbers"),
        F.round(F.aggregate("transcript_embedding", F.lit(0.0), lambda total, x: total + x.cast("double")), 5).alias("total"),
        F.round(F.get("transcript_embedding", F.lit(0)).cast("double"), 6).alias("first_number"),
    )


# -- search --------------------------------------------------------------------


def _hits(d: Domain, **options) -> DataFrame:
    return search.search_chunks(d.questions, d.embeddings, d.episodes, d.podcasts, **options)


@query
def search_chunks(d: Domain) -> DataFrame:
    return _hits(d, threshold=0.2).withColumn("similarity", _score("similarity", "similarity"))


@query
def search_chunks_tiled(d: Domain) -> DataFrame:
    """The same search the way a query table too large to travel takes."""
    found = _hits(d, threshold=0.2, max_query_bytes=2048)
    return found.withColumn("similarity", _score("similarity", "similarity"))


@query
def search_episodes(d: Domain) -> DataFrame:
    found = search.search_episodes(d.questions, d.embeddings, d.episodes, d.podcasts)
    return found.withColumn("similarity_score", _score("similarity_score", "similarity_score"))


@query
def search_within(d: Domain) -> DataFrame:
    """The chunks of every episode closest to its last one."""
    asked = d.embeddings.groupBy("episode_id").agg(
        F.max_by("transcript_embedding", "chunk_index").alias("query_vector")
    ).withColumn("query_id", F.col("episode_id"))
    found = search.search_within(asked, d.embeddings, top_k=3)
    return found.withColumn("similarity_score", _score("similarity_score", "similarity_score"))


@query
def search_every_chunk(d: Domain) -> DataFrame:
    """Every stored vector as a query."""
    asked = d.embeddings.select(
        (F.col("episode_id") * 5 + F.col("chunk_index")).alias("query_id"), F.col("transcript_embedding").alias("query_vector")
    )
    found = search.search_chunks(asked, d.embeddings, d.episodes, d.podcasts, limit=3, threshold=0.2)
    return found.select("query_id", "rank", "episode_id", "chunk_index", _score("similarity", "similarity"))


def _similar(d: Domain, ids: DataFrame) -> DataFrame:
    return search.similar_episodes(d.embeddings, d.episodes, d.podcasts, ids)


@query
def similar_episodes(d: Domain) -> DataFrame:
    """Neighbours of every episode."""
    found = _similar(d, d.embeddings)
    return found.withColumn("similarity_score", _score("similarity_score", "similarity_score"))


@query
def ann_search(d: Domain) -> DataFrame:
    """Every twentieth vector against quantised lists, a quarter of the cells opened."""
    return _quantised(d).select("query_id", "rank", "episode_id", "chunk_index", _score("similarity", "similarity"))


def _quantised(d: Domain) -> DataFrame:
    quantiser = quantised.train(d.embeddings)
    path = scratch_path(d.spark, "lists")
    quantised.build_index(d.embeddings, path, quantiser)
    return quantised.quantised_search(d.questions, d.embeddings, path, quantiser)


@query
def ann_search_all_cells(d: Domain) -> DataFrame:
    """With every cell probed the answer is exact."""
    centers = search.train_cells(d.embeddings, n_cells=16)
    cells = search.store_cells(d.embeddings, centers, scratch_path(d.spark, "cells"))
    return search.ann_search(d.questions, cells, centers, n_probe=16).select(
        "query_id", "rank", "episode_id", "chunk_index", _score("similarity", "similarity")
    )


def _recall(d: Domain) -> DataFrame:
    """Exact hits and how many of them ``ann_search`` finds."""
    exact = search.best_matches(d.questions, d.embeddings, search.Ranking(5)).frame
    key = ["query_id", "episode_id", "chunk_index"]
    near = _quantised(d).select(*key, F.lit(1).alias("_found"))
    return exact.join(near, key, "left").agg(F.count("*").alias("hits"), F.count("_found").alias("found"))


@query
def ann_recall(d: Domain) -> DataFrame:
    """Whether the search of ``ann_search`` finds nine tenths of the exact hits."""
    return _recall(d).select("hits", (F.col("found") >= 0.9 * F.col("hits")).alias("recall_reached"))


@query
def embedding_coverage(d: Domain) -> DataFrame:
    return search.embedding_coverage(d.episodes, d.embeddings)


@query
def search_by_distance(d: Domain) -> DataFrame:
    found = _hits(d, threshold=None, metric="l2")
    return found.select(
        "query_id", "rank", "episode_id", "chunk_index", "podcast_name", _score("distance", "distance")
    )


@query
def sentence_starts(d: Domain) -> DataFrame:
    half = d.transcripts.select("episode_id", F.expr("substr(transcript_text, 2)").alias("text"))
    return half.select("episode_id", sentence_start(F.col("text")).alias("chunk_text"))


def _contexts(d: Domain, chats: DataFrame) -> DataFrame:
    """What the asked episode itself says, per conversation and episode."""
    found = search.search_within(chats, d.embeddings, top_k=5)
    return context.chunk_context(found, chats)


@query
def chunk_context(d: Domain) -> DataFrame:
    return _contexts(d, fixed(d.chats))


@query
def similar_context(d: Domain) -> DataFrame:
    """Recommendations for every episode."""
    asked = d.embeddings.select(F.col("episode_id").alias("query_id")).distinct()
    return context.similar_context(_similar(d, d.embeddings), asked)


@query
def message_context(d: Domain) -> DataFrame:
    """Message, episode it is about, chunks of that episode and, where asked for, episodes like it."""
    chats = fixed(d.chats)
    wishes = d.messages.filter(context.asks_for_similar(F.col("message"))).select("conv_id").distinct()
    wishing = chats.join(wishes, "conv_id", "left_semi").select("query_id", "episode_id")
    about = wishing.select(F.col("episode_id").alias("query_id")).distinct()
    lists = context.similar_context(_similar(d, about.select(F.col("query_id").alias("episode_id"))), about)
    wanted = wishing.join(lists.withColumnRenamed("query_id", "episode_id"), "episode_id")
    messages = d.messages.join(chats.select("conv_id", "query_id"), "conv_id")
    return context.with_context(messages, _contexts(d, chats), wanted).select(
        "conv_id", "turn", "query_id", "wants_similar", "context", "similar_episodes"
    )


@query
def chat_request(d: Domain) -> DataFrame:
    current = d.raw("conversations").select("conv_id").distinct().withColumn(
        "message", F.concat(F.lit("And what about "), F.col("conv_id"), F.lit("?"))
    )
    return context.chat_request(d.raw("conversations"), current, 3)


@query
def recent_turns(d: Domain) -> DataFrame:
    return context.recent_turns(d.raw("conversations"), 3).select("conv_id", "turn", "role", "text", "position")


@query
def keyword_search(d: Domain) -> DataFrame:
    transcripts = d.transcripts.select(F.col("episode_id").cast("bigint").alias("episode_id"), "transcript_text")
    titled = transcripts.select(
        "episode_id", F.concat(F.lit("The "), F.col("episode_id"), F.lit(" and more")).alias("episode_title")
    )
    return keywords.keyword_search(d.keywords, titled, transcripts)


@query
def filter_episodes(d: Domain) -> DataFrame:
    return context.filter_episodes(
        {
            "episode": d.episodes, "podcast": d.podcasts, "topics": d.topics, "speakers": d.speakers,
            "episode_topics": d.episode_topics, "episode_speakers": d.episode_speakers,
        },
        topics=["RED WIDGET", "BLUE BOLT", "SMALL RING", "HOT GEAR"],
        speakers=[f"Supplier#{i:09d}" for i in range(40)],
        podcasts=["BUILDING", "MACHINERY"],
        since=datetime(1996, 1, 1),
        until=datetime(2000, 6, 30),
    )


# -- dashboard -----------------------------------------------------------------


@query
def episodes_with_podcast(d: Domain) -> DataFrame:
    return _flag(analytics.episodes_with_podcast(d.episodes, d.podcasts).drop("publish_date"))


@query
def content_counts(d: Domain) -> DataFrame:
    return analytics.content_counts(d.episodes, d.podcasts)


@query
def content_counts_by_name(d: Domain) -> DataFrame:
    return analytics.content_counts(d.episodes, d.podcasts, by="podcast_name")


@query
def episodes_per_podcast(d: Domain) -> DataFrame:
    return analytics.episodes_per_podcast(d.episodes, d.podcasts)


@query
def topics_per_podcast(d: Domain) -> DataFrame:
    return analytics.topics_per_podcast(d.episodes, d.podcasts, d.topics, d.episode_topics)


@query
def top_topics(d: Domain) -> DataFrame:
    return analytics.top_topics(d.episodes, d.podcasts, d.topics, d.episode_topics)


@query
def published_timeline(d: Domain) -> DataFrame:
    return analytics.published_timeline(d.episodes, d.podcasts)


@query
def cumulative_published(d: Domain) -> DataFrame:
    as_of = F.lit(datetime(1999, 3, 31)).cast("timestamp_ntz")
    return analytics.cumulative_published(d.episodes, d.podcasts, as_of)


@query
def topics_per_episode(d: Domain) -> DataFrame:
    return _flag(analytics.topics_per_episode(d.episodes, d.podcasts, d.episode_topics))


@query
def episode_details(d: Domain) -> DataFrame:
    return _flag(analytics.episode_details(d.episodes, d.podcasts, d.episode_topics, d.episode_speakers))


@query
def topic_frequency(d: Domain) -> DataFrame:
    return analytics.topic_frequency(d.episodes, d.podcasts, d.topics, d.episode_topics, 5)


@query
def speaker_frequency(d: Domain) -> DataFrame:
    return analytics.speaker_frequency(d.episodes, d.podcasts, d.speakers, d.episode_speakers)


@query
def top_speakers(d: Domain) -> DataFrame:
    return analytics.speaker_frequency(d.episodes, d.podcasts, d.speakers, d.episode_speakers, 5)


@query
def podcast_stats(d: Domain) -> DataFrame:
    stats = analytics.podcast_stats(d.episodes, d.podcasts, d.episode_topics, d.episode_speakers)
    return stats.withColumns(
        {c: F.round(c, 6) for c in ("avg_topics_per_episode", "avg_speakers_per_episode")}
    )


@query
def word_counts(d: Domain) -> DataFrame:
    return analytics.word_counts(d.transcripts)


@query
def transcript_length_series(d: Domain) -> DataFrame:
    return analytics.transcript_length_series(d.episodes, d.transcripts)


@query
def word_count_summary(d: Domain) -> DataFrame:
    return analytics.word_count_summary(d.transcripts)

"""The recurring jobs over a folder of table versions: read, compute, publish the next version.

Every job takes whole landed tables and gives back a frame with one status per
item, so a bad item is a row in a report and never stops the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.keys import require_distinct_ids
from earshot.operators import analysis, embedding, ingest, transcription
from earshot.schemas import TABLES
from earshot.session import fixed, tune
from earshot.sources import feeds, keyed, lake
from earshot.sources.tables import current_version, publish, read_snapshot


# Datasets of single rows that change, in key buckets: which episodes are transcribed, and their vectors.
FLAGS, VECTORS = "episode_transcribed", "episode_embedding"


def read_episodes(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The episode table with the flags of what was transcribed since its rows were loaded."""
    episodes = read_snapshot(spark, root, "episode", version)
    if keyed.bucket_count(spark, f"{root}/{FLAGS}") is None:
        return episodes
    return transcription.apply_transcribed(episodes, keyed.read(spark, f"{root}/{FLAGS}"))


def read_embeddings(spark: SparkSession, root: str) -> DataFrame:
    """The stored chunks with their vectors."""
    if keyed.bucket_count(spark, f"{root}/{VECTORS}") is None:
        return spark.createDataFrame([], TABLES[VECTORS])
    return keyed.read(spark, f"{root}/{VECTORS}")


def add_podcasts(spark: SparkSession, root: str, documents: DataFrame, loaded_at: Column) -> DataFrame:
    """Register the podcasts behind landed feed documents (``url``, ``body``).

    Status per document: added, duplicate, or why it was rejected.
    """
    tune(spark)
    gated = ingest.gate_feed_urls(documents)
    refused = gated.filter(F.col("reject_reason").isNotNull()).select("url", F.col("reject_reason").alias("status"))
    readable = gated.filter(F.col("reject_reason").isNull()).select("url", "body")
    accepted, rejected = ingest.validate_feeds(feeds.parse_feed_headers(readable))
    accepted = fixed(accepted)
    now = current_version(spark, root)
    known, spoken = (read_snapshot(spark, root, name, now) for name in ("podcast", "language"))
    podcasts, languages, status = ingest.upsert_podcasts(accepted, known, spoken, "url", loaded_at)
    status = fixed(status.select("url", "status"))
    require_distinct_ids(podcasts, "podcast_id", F.col("podcast_url"))
    require_distinct_ids(languages, "language_id", F.col("language_name"))
    new = lambda df, old, key: df.join(old.select(key), key, "left_anti")
    publish(
        spark, root,
        appended={"language": new(languages, spoken, "language_id"), "podcast": new(podcasts, known, "podcast_id")},
    )
    return status.unionByName(refused).unionByName(
        rejected.select("url", F.col("reject_reason").alias("status"))
    )


def load_new_episodes(
    spark: SparkSession, root: str, documents: DataFrame, fetched_at: Column, first_n: int = 20
) -> DataFrame:
    """Load what is new in the landed feeds of known podcasts; gives the load statistics."""
    tune(spark)
    now = current_version(spark, root)
    podcasts = read_snapshot(spark, root, "podcast", now)
    episodes = read_snapshot(spark, root, "episode", now)
    # All documents of a call are one poll; equal ones are read once, every version of a feed is read.
    once = documents.select("url", "body").distinct().withColumn("_document", F.sha2("body", 256))
    landed = once.withColumn("fetched_at", fetched_at.cast("timestamp_ntz"))
    entries = ingest.merge_versions(ingest.landed_entries(landed, podcasts, ["_document"]), "_document")
    fresh = ingest.select_new_episodes(entries, ingest.ingest_cutoffs(episodes), first_n)
    accepted = fixed(ingest.validate_episodes(fresh)[0])
    inserted, outcomes = ingest.load_episodes(accepted, episodes, podcasts)
    stats = fixed(ingest.load_stats(outcomes))
    inserted = fixed(inserted)
    ingest.require_new_ids(episodes, inserted)
    publish(spark, root, appended={"episode": inserted})
    return stats


def store_transcripts(
    spark: SparkSession, root: str, slices: DataFrame, segments: DataFrame, lake_root: str
) -> DataFrame:
    """Store the texts and segments of transcribed slices, then mark their episodes.

    ``slices`` has ``episode_id, slice_index, duration_s, ok, text``; the
    segments are relative to their slice. Failed episodes keep their flag.
    """
    tune(spark)
    episodes = read_snapshot(spark, root, "episode")
    # Slices of an unknown episode are a failed item of the report and stop nothing.
    known = episodes.select("episode_id", "podcast_id", F.lit(True).alias("_known"))
    results = fixed(
        transcription.assemble_text(slices)
        .join(known, "episode_id", "left")
        .withColumn("status", F.when(F.col("_known"), F.col("status")).otherwise("failed"))
        .drop("_known")
    )
    done = results.filter("status = 'success'")
    keys = [F.col(k).cast("string").alias(k) for k in lake.KEYS]
    lake.replace_episodes(done.select(*keys, "transcript_text"), f"{lake_root}/transcripts")
    stitched = transcription.stitch_segments(slices, segments).join(done.select("episode_id", "podcast_id"), "episode_id")
    lake.replace_episodes(
        stitched.select(*keys, "start_time", "end_time", "speaker", "text"), f"{lake_root}/segments", "start_time"
    )
    # The flags are the last to be written, and only in the buckets of these episodes.
    keyed.replace(done.select("episode_id"), f"{root}/{FLAGS}", ["episode_id"])
    return transcription.route_outcomes(results.select("episode_id", "podcast_id", "status"))


def store_analyses(spark: SparkSession, root: str, responses: DataFrame, lake_root: str) -> DataFrame:
    """Load the answers of the analysis model (``episode_id, response``).

    Topics and speakers go to the tables, summaries to the lake.
    """
    tune(spark)
    now = current_version(spark, root)
    episodes = read_snapshot(spark, root, "episode", now)
    parsed = fixed(analysis.parse_analysis(responses))
    answers = parsed.filter("status = 'parsed'")
    tables = {name: read_snapshot(spark, root, name, now) for name in
              ("topics", "speakers", "episode_topics", "episode_speakers")}
    new = {name: fixed(df) for name, df in analysis.analysis_additions(answers, episodes, tables).items()}
    names = ("topics", "speakers")
    analysis.check_analysis_ids({n: tables[n].select(*new[n].columns).unionByName(new[n]) for n in names})
    publish(spark, root, appended=new)
    status = analysis.analysis_status(answers, episodes).select("episode_id", "status")
    summaries = answers.join(episodes.select("episode_id", "podcast_id"), "episode_id")
    lake.write_summaries(summaries, f"{lake_root}/summaries")
    return status.unionByName(parsed.filter("status = 'failed'").select("episode_id", "status"))


def store_embeddings(
    spark: SparkSession,
    root: str,
    transcripts: DataFrame,
    embedder: embedding.Embedder,
    dim: int = 1536,
    size: int = 512,
    overlap: int = 256,
    min_length: int = 100,
) -> DataFrame:
    """Chunk, embed and store transcripts (``episode_id, transcript_text``), replacing older chunks."""
    tune(spark)
    gated = embedding.gate_transcripts(transcripts, min_length)
    usable = gated.filter(F.col("reject_reason").isNull()).select(
        F.col("episode_id").cast("bigint").alias("episode_id"),
        embedding.space_tokens(F.col("transcript_text")).alias("tokens"),
    )
    chunks, _ = embedding.chunk_transcripts(usable, size, overlap)
    embedded, failed = embedding.embed_chunks(chunks, embedder)
    verdict = embedding.validate_embeddings(embedded, dim)
    episodes = read_snapshot(spark, root, "episode")
    valid = embedding.keep_valid(embedded, verdict).withColumn("chunk_index", F.col("chunk_index").cast("bigint"))
    new, unknown = (fixed(df) for df in embedding.storable_embeddings(valid, episodes))
    keyed.replace(new, f"{root}/{VECTORS}", ["episode_id"], "chunk_index")
    number = F.col("episode_id").cast("bigint").alias("episode_id")
    report = lambda df, label: df.select(number, F.lit(label).alias("status"))
    refused = gated.filter(F.col("reject_reason").isNotNull())
    return (
        report(verdict.filter("is_valid").join(unknown, "episode_id", "left_anti"), "stored")
        .unionByName(report(unknown, "episode missing"))
        .unionByName(report(verdict.filter("not is_valid"), "wrong dimension"))
        .unionByName(report(failed, "embedding failed"))
        .unionByName(refused.select(number, F.col("reject_reason").alias("status")))
    )

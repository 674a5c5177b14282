"""Requests to and results of transcript analysis (the model call is not ours)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.grouping import first_per_group, ordered_concat, top_n
from earshot.functions.keys import hash_id, require_distinct_ids
from earshot.functions.text import is_missing, strip

# Layout of the speaker block in an analysis request.
SAMPLES_HEADING = "\n\nSPEAKER SAMPLES (for identification):\n"
SAMPLE_LINE = "\nSpeaker %s said:\n\"%s\"\n"


def speaker_samples(segments: DataFrame, max_chars: int = 500) -> DataFrame:
    """The first ``max_chars`` characters each speaker says in an episode.

    ``segments`` has ``episode_id, pos, speaker, text``. Every kept text adds at
    least two characters, so half of ``max_chars`` rows per speaker are enough,
    which bounds what a group can hold.
    """
    who = ["episode_id", "speaker"]
    # No more of a text can show up in the sample than the sample has characters.
    start = F.substring(strip(F.col("text")), 1, max_chars)
    said = segments.select(*who, "pos", start.alias("text")).filter(
        ~is_missing(F.col("speaker")) & ~is_missing(F.col("text"))
    )
    spoken = top_n(said, who, [F.col("pos")], max_chars // 2 + 1, salt_by=["pos"]).drop("rank")
    earlier = Window.partitionBy(*who).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.length("text") + 1).over(earlier), F.lit(0))
    return (
        spoken.withColumn("_used", used)
        .filter(F.col("_used") < max_chars)
        .groupBy(*who)
        .agg(
            F.min("pos").alias("first_pos"),
            F.expr("listagg(text, ' ') WITHIN GROUP (ORDER BY pos)").alias("sample"),
        )
        .withColumn("sample", strip(F.substring("sample", 1, max_chars)))
    )


def analysis_requests(
    transcripts: DataFrame, samples: DataFrame | None = None, max_chars: int = 10_000
) -> DataFrame:
    """One request per episode: the transcript's beginning and the speaker block.

    Speakers are listed in order of first appearance; an episode without
    samples has no block.
    """
    cut = transcripts.select("episode_id", F.substring("transcript_text", 1, max_chars).alias("transcript"))
    if samples is None:
        return cut.withColumn("speaker_block", F.lit("")).withColumn("request", F.col("transcript"))
    lines = samples.select(
        "episode_id", "first_pos", F.format_string(SAMPLE_LINE, "speaker", "sample").alias("line")
    )
    blocks = ordered_concat(lines, ["episode_id"], "first_pos", "line", "", "lines")
    block = F.coalesce(F.concat(F.lit(SAMPLES_HEADING), F.col("lines")), F.lit(""))
    return (
        cut.join(blocks, "episode_id", "left")
        .withColumn("speaker_block", block)
        .withColumn("request", F.concat("transcript", "speaker_block"))
        .drop("lines")
    )


def parse_analysis(responses: DataFrame) -> DataFrame:
    """JSON answers (``episode_id, response``) to topics, summary and speaker names.

    Absent fields get their defaults; a speaker counts only as an object whose
    ``name`` is a non-blank string. What is no JSON object is ``failed``.
    """
    nothing = F.array().cast("array<string>")
    # Read as a list, so that text behind the object is an error.
    listed = F.try_parse_json(F.concat(F.lit("["), F.col("response"), F.lit("]")))
    element = lambda i: F.try_variant_get("_list", f"$[{i}]", "variant")
    is_object = F.schema_of_variant("_answer").startswith("OBJECT") & element(1).isNull()
    field = lambda name, kind: F.try_variant_get("_answer", f"$.{name}", kind)
    name_of = lambda speaker: F.try_variant_get(speaker, "$.name", "variant")
    is_text = lambda value: F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))
    named = F.filter(field("speakers", "array<variant>"), lambda speaker: is_text(name_of(speaker)))
    names = F.transform(named, lambda speaker: strip(F.try_variant_get(speaker, "$.name", "string")))
    ok = F.col("status") == "parsed"
    return (
        responses.withColumn("_list", listed)
        .withColumn("_answer", element(0))
        .withColumn("status", F.when(is_object, "parsed").otherwise("failed"))
        .select(
            "episode_id",
            "status",
            F.when(ok, F.coalesce(field("topics", "array<string>"), nothing)).alias("topics"),
            F.when(ok, F.coalesce(field("summary", "string"), F.lit(""))).alias("summary"),
            F.when(ok, F.coalesce(F.filter(names, lambda n: n != ""), nothing)).alias("speakers"),
        )
    )


def new_topics(
    analysis: DataFrame, topics: DataFrame, episode_topics: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Topics and links of ``analysis`` that are not stored yet; names are exact."""
    named = analysis.select("episode_id", F.explode("topics").alias("topic_name")).filter(
        F.col("topic_name").isNotNull()
    )
    known = topics.select("topic_id", "topic_name")
    # A new topic's id follows from its name, so linking needs the known topics only.
    new_id = hash_id(F.col("topic_name"))
    new = named.select("topic_name").distinct().join(known, "topic_name", "left_anti")
    links = named.distinct().join(known, "topic_name", "left").select(
        "episode_id", F.coalesce("topic_id", new_id).alias("topic_id")
    )
    missing = links.distinct().join(episode_topics, ["episode_id", "topic_id"], "left_anti")
    return new.select(new_id.alias("topic_id"), "topic_name"), missing


def upsert_topics(
    analysis: DataFrame, topics: DataFrame, episode_topics: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Topic and bridge tables with the topics of ``analysis`` in them."""
    new, links = new_topics(analysis, topics, episode_topics)
    bridge = episode_topics.select("episode_id", "topic_id").unionByName(links)
    return topics.select("topic_id", "topic_name").unionByName(new), bridge


def new_speakers(
    analysis: DataFrame, speakers: DataFrame, episode_speakers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Speakers and links that are not stored yet; names match without regard to case.

    A new speaker keeps the first spelling, by episode and list position.
    """
    key = F.lower("speaker_name")
    named = analysis.select(
        "episode_id", F.posexplode("speakers").alias("_pos", "speaker_name")
    ).withColumn("_key", key)
    # Names differing in case may both be stored; the lowest id stands for them.
    known = speakers.groupBy(key.alias("_key")).agg(F.min("speaker_id").alias("speaker_id"))
    spellings = first_per_group(
        named.filter(F.col("_key").isNotNull()), ["_key"], ["episode_id", "_pos"], ["speaker_name"]
    )
    new_id = hash_id(F.col("_key"))
    new = spellings.join(known, "_key", "left_anti").select(
        new_id.alias("speaker_id"), "speaker_name", F.lit(None).cast("string").alias("speaker_username")
    )
    links = (
        named.filter(F.col("_key").isNotNull())
        .select("episode_id", "_key")
        .distinct()
        .join(known, "_key", "left")
        .select("episode_id", F.coalesce("speaker_id", new_id).alias("speaker_id"))
    )
    missing = links.distinct().join(episode_speakers, ["episode_id", "speaker_id"], "left_anti")
    return new, missing


def upsert_speakers(
    analysis: DataFrame, speakers: DataFrame, episode_speakers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Speaker and bridge tables with the speakers of ``analysis`` in them."""
    new, links = new_speakers(analysis, speakers, episode_speakers)
    bridge = episode_speakers.select("episode_id", "speaker_id").unionByName(links)
    return speakers.select(*new.columns).unionByName(new), bridge


def analysis_status(analysis: DataFrame, episodes: DataFrame) -> DataFrame:
    """Add ``status``: an analysis needs topics and an existing episode."""
    known = episodes.select("episode_id").distinct().withColumn("_known", F.lit(True))
    status = (
        F.when(F.col("topics").isNull(), "topics missing")
        .when(F.col("_known").isNull(), "episode missing")
        .otherwise("stored")
    )
    return (
        analysis.drop("status").join(known, "episode_id", "left").withColumn("status", status).drop("_known")
    )


def store_analysis(
    analysis: DataFrame, episodes: DataFrame, tables: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """The four topic and speaker tables after loading every storable analysis.

    The result is meant to be published as one set of versions.
    """
    storable = analysis_status(analysis, episodes).filter(F.col("status") == "stored")
    topics, episode_topics = upsert_topics(storable, tables["topics"], tables["episode_topics"])
    speakers, episode_speakers = upsert_speakers(storable, tables["speakers"], tables["episode_speakers"])
    return {
        "topics": topics,
        "episode_topics": episode_topics,
        "speakers": speakers,
        "episode_speakers": episode_speakers,
    }


def analysis_additions(
    analysis: DataFrame, episodes: DataFrame, tables: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """The rows that every storable analysis adds to the four topic and speaker tables."""
    storable = analysis_status(analysis, episodes).filter(F.col("status") == "stored")
    topics, episode_topics = new_topics(storable, tables["topics"], tables["episode_topics"])
    speakers, episode_speakers = new_speakers(storable, tables["speakers"], tables["episode_speakers"])
    return {
        "topics": topics,
        "episode_topics": episode_topics,
        "speakers": speakers,
        "episode_speakers": episode_speakers,
    }


def check_analysis_ids(tables: dict[str, DataFrame]) -> None:
    """Fail before publishing when hashed topic or speaker ids clash."""
    require_distinct_ids(tables["topics"], "topic_id", F.col("topic_name"))
    require_distinct_ids(tables["speakers"], "speaker_id", F.lower("speaker_name"))


def _names_per_episode(bridge: DataFrame, names: DataFrame, key: str, name: str, out: str) -> DataFrame:
    linked = bridge.select("episode_id", key).distinct().join(names.select(key, name), key)
    return linked.groupBy("episode_id").agg(F.sort_array(F.collect_list(name)).alias(out))


def episode_analysis(
    episodes: DataFrame,
    topics: DataFrame,
    episode_topics: DataFrame,
    speakers: DataFrame,
    episode_speakers: DataFrame,
) -> DataFrame:
    """Topic and speaker names per episode; the summary lives in the lake and is NULL here.

    The two lists are built apart, so they do not multiply each other.
    """
    nothing = F.array().cast("array<string>")
    topic_lists = _names_per_episode(episode_topics, topics, "topic_id", "topic_name", "topics")
    speaker_lists = _names_per_episode(episode_speakers, speakers, "speaker_id", "speaker_name", "speakers")
    return (
        episodes.select("episode_id")
        .join(topic_lists, "episode_id", "left")
        .join(speaker_lists, "episode_id", "left")
        .select(
            "episode_id",
            F.coalesce("topics", nothing).alias("topics"),
            F.coalesce("speakers", nothing).alias("speakers"),
            F.lit(None).cast("string").alias("summary"),
        )
    )

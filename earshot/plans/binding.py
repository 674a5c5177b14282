"""The domain tables, derived from the given star-schema tables.

Every frame covers its whole source table; value predicates only decide which
variant (a blank title, a missing link) a row shows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.grouping import ordered_concat
from earshot.session import tune

ONE_SPLIT = 128 << 20
RFC = "EEE, dd MMM yyyy HH:mm:ss"


class Domain:
    """Lazily built frames of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table that costs much work per row, over all cores even if it is one small file.

        Only an input below one scan split is moved; larger ones are parallel as they are.
        """
        df = self.raw(name)
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size >= ONE_SPLIT:
            return df
        return df.repartition(self.spark.sparkContext.defaultParallelism)

    # -- relational tables -------------------------------------------------

    @cached_property
    def languages(self) -> DataFrame:
        return self.raw("nation").selectExpr("CAST(n_nationkey AS BIGINT) AS language_id", "n_name AS language_name")

    @cached_property
    def podcasts(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS podcast_id",
            "c_mktsegment AS podcast_name",
            "CAST(NULL AS TIMESTAMP_NTZ) AS publish_date",
            "CAST(c_nationkey AS BIGINT) AS language_id",
            "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS uploaded_at",
            "concat('https://feeds.example/', c_custkey,"
            " CASE WHEN c_mktsegment = 'FURNITURE' THEN '.json' ELSE '.rss' END) AS podcast_url",
        )

    @cached_property
    def episodes(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS episode_id",
            "o_custkey AS podcast_id",
            "o_orderdate + INTERVAL 1 DAY AS uploaded_at",
            "concat('https://audio.example/', o_orderkey, '.mp3') AS audio_url",
            "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS transcribed",
            "o_orderdate AS published_at",
            "concat('Episode ', o_orderkey) AS episode_title",
        )

    @cached_property
    def topics(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS topic_id",
            "CASE WHEN p_size > 25 THEN upper(p_name) ELSE concat(p_name, '-', lower(p_type)) END AS topic_name",
        )

    @cached_property
    def speakers(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS speaker_id", "s_name AS speaker_name", "CAST(NULL AS STRING) AS speaker_username"
        )

    @cached_property
    def episode_topics(self) -> DataFrame:
        return self.raw("lineitem").selectExpr("l_orderkey AS episode_id", "l_partkey AS topic_id").distinct()

    @cached_property
    def episode_speakers(self) -> DataFrame:
        return self.raw("lineitem").selectExpr("l_orderkey AS episode_id", "l_suppkey AS speaker_id").distinct()

    # -- lake --------------------------------------------------------------

    @cached_property
    def transcripts(self) -> DataFrame:
        return self.spread("documents").selectExpr(
            "source AS podcast_id", "CAST(doc_id AS STRING) AS episode_id", "text AS transcript_text"
        )

    @cached_property
    def turns(self) -> DataFrame:
        """Conversation turns as diarised segments."""
        return self.raw("conversations").selectExpr(
            "conv_id AS episode_id",
            "turn AS pos",
            "role AS speaker",
            "turn * 2.0D AS start_time",
            "turn * 2.0D + 1.5D AS end_time",
            "text",
        )

    @cached_property
    def summaries(self) -> DataFrame:
        return self.raw("documents").selectExpr(
            "source AS podcast_id",
            "CAST(doc_id AS STRING) AS episode_id",
            "CASE WHEN n_chars < 300 THEN NULL ELSE text END AS summary",
            "CASE WHEN lang <> 'fr' THEN array(lang, source) END AS topics",
            "array(upper(source)) AS speakers",
        )

    @cached_property
    def analyses(self) -> DataFrame:
        """Parsed analyses: topics and speakers with repeats and spellings of their own."""
        return self.raw("documents").selectExpr(
            "doc_id AS episode_id",
            "CASE WHEN n_chars < 200 THEN NULL"
            " ELSE array(lang, source, lang, concat('chars ', n_chars div 1000)) END AS topics",
            "array(CASE WHEN n_chars > 1500 THEN upper(source) ELSE source END,"
            " concat('Host ', lang), upper(concat('host ', lang))) AS speakers",
        )

    @cached_property
    def responses(self) -> DataFrame:
        """Model answers as JSON text, some of them not usable."""
        return self.raw("documents").selectExpr(
            "doc_id AS episode_id",
            """CASE
                 WHEN n_chars < 300 THEN concat('not json ', lang)
                 WHEN n_chars < 500 THEN '[1, 2]'
                 WHEN n_chars < 700 THEN '{}'
                 WHEN n_chars < 1000 THEN concat('{"topics": ["', lang, '"]}')
                 ELSE concat('{"topics": ["', lang, '", "', source, '"], "summary": ', to_json_text,
                             ', "speakers": [{"name": " ', source, ' "}, "', lang,
                             '", {"name": ', n_chars, '}, {"name": "  "}, {"nick": "x"}, {"name": "Host"}]}')
               END AS response"""
            .replace("to_json_text", "concat('\"about ', lang, '\"')"),
        )

    # -- vectors -----------------------------------------------------------

    @cached_property
    def embeddings(self) -> DataFrame:
        """Five chunks per episode; chunk texts are documents without their first character."""
        texts = self.raw("documents").selectExpr("doc_id AS vec_id", "substr(text, 2) AS chunk_text")
        return (
            self.raw("embeddings")
            .join(texts, "vec_id", "left")
            .selectExpr(
                "vec_id div 5 AS episode_id",
                "vec_id % 5 AS chunk_index",
                "coalesce(chunk_text, '') AS chunk_text",
                "embedding AS transcript_embedding",
            )
        )

    @cached_property
    def questions(self) -> DataFrame:
        """Every twentieth stored vector."""
        asked = self.raw("embeddings").filter("vec_id % 20 = 0")
        return asked.selectExpr("CAST(vec_id AS BIGINT) AS query_id", "embedding AS query_vector")

    @cached_property
    def chats(self) -> DataFrame:
        """What conversations ask about episodes: every conversation and every stored episode takes part."""
        vectors = self.raw("embeddings").selectExpr("CAST(vec_id AS BIGINT) AS vec_id", "embedding AS query_vector")
        talks = self.raw("conversations").select("conv_id").distinct()
        shows = vectors.selectExpr("vec_id div 5 AS episode_id").distinct()
        n_talks, n_shows, n_vectors = talks.count(), shows.count(), vectors.count()
        if not n_talks or not n_shows:
            about = talks.join(shows, F.lit(False))
        else:
            by_talk = talks.join(shows, F.pmod("conv_id", F.lit(n_shows)) == F.col("episode_id"))
            by_show = talks.join(shows, F.pmod("conv_id", F.lit(n_talks)) == F.pmod("episode_id", F.lit(n_talks)))
            about = by_talk.unionByName(by_show).distinct()
        asked = about.withColumn("vec_id", F.pmod(F.col("conv_id") * 7, F.lit(max(n_vectors, 1))))
        return asked.join(vectors, "vec_id").select(
            (F.col("conv_id") * n_shows + F.col("episode_id")).alias("query_id"), "conv_id", "episode_id", "query_vector"
        )

    @cached_property
    def messages(self) -> DataFrame:
        return self.raw("conversations").selectExpr(
            "conv_id", "turn",
            "CASE WHEN role = 'system' THEN concat('Please RECOMMEND ', text)"
            " WHEN turn = 2 THEN concat('Similar ones? ', text) ELSE text END AS message",
        )

    @cached_property
    def keywords(self) -> DataFrame:
        """Every word of the benchmark texts, numbered by where it stands first."""
        words = self.raw("benchmark").selectExpr("item_id", "posexplode(split(lower(text), ' ')) AS (pos, keyword)")
        return words.filter("keyword <> ''").groupBy("keyword").agg(F.expr("min(item_id * 100000 + pos)").alias("query_id"))

    # -- feeds -------------------------------------------------------------

    @cached_property
    def feeds(self) -> DataFrame:
        """Parsed feed headers, one per customer."""
        link = "array<struct<rel:string,type:string,href:string>>"
        stamp = "TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(c_nationkey, 0, CAST(c_custkey % 1440 AS INT), 0)"
        return self.raw("customer").selectExpr(
            "c_custkey AS row_id",
            "CASE WHEN c_acctbal < -500 THEN '   ' WHEN c_acctbal < 0 THEN NULL"
            " ELSE concat('  ', c_name, '\\t') END AS title",
            f"CASE WHEN c_acctbal > 9000 THEN '2020-01-01' ELSE concat(date_format({stamp}, '{RFC}'),"
            " CASE WHEN c_mktsegment = 'BUILDING' THEN ' +0530' ELSE ' +0000' END) END AS published",
            "CASE WHEN c_nationkey = 3 THEN ' ' ELSE concat(' EN-', c_nationkey, ' ') END AS language",
            "CASE c_mktsegment WHEN 'MACHINERY' THEN concat('https://site.example/', c_nationkey)"
            " WHEN 'FURNITURE' THEN concat('https://site.example/', c_custkey, '.xml') END AS link",
            "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN concat('https://moved.example/', c_custkey, '.rss') END"
            " AS new_feed_url",
            f"CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN array("
            " named_struct('rel', 'alternate', 'type', 'text/html', 'href', 'https://page.example/'),"
            " named_struct('rel', 'self', 'type', 'application/rss+xml',"
            " 'href', concat('https://self.example/', c_custkey % 200, '.rss')))"
            f" ELSE array() END AS {link}) AS links",
        )

    @cached_property
    def entries(self) -> DataFrame:
        """Feed entries, one per event; many share an audio address."""
        named = self.raw("customer").selectExpr(
            "c_custkey AS user_id", "c_mktsegment AS podcast_name",
            "concat('https://feeds.example/', c_custkey,"
            " CASE WHEN c_mktsegment = 'FURNITURE' THEN '.json' ELSE '.rss' END) AS podcast_url",
        )
        link = "array<struct<rel:string,type:string,href:string>>"
        audio = "concat('https://cdn.example/', event_type, '/', CAST(floor(value) AS BIGINT), '.mp3')"
        page = "concat('https://page.example/', event_id)"
        return (
            self.spread("events")
            .join(named, "user_id", "left")
            .selectExpr(
                "user_id AS podcast_id",
                "podcast_name",
                "podcast_url",
                "event_id AS feed_pos",
                "CASE WHEN value < 2 THEN '  ' ELSE concat('  ', event_type, ' ', event_id, ' ') END AS title",
                f"""CAST(CASE event_type
                      WHEN 'click' THEN array(
                        named_struct('rel', 'alternate', 'type', 'text/html', 'href', {page}),
                        named_struct('rel', 'enclosure', 'type', 'audio/mpeg', 'href', concat(' ', {audio})))
                      WHEN 'view' THEN array(named_struct('rel', 'alternate', 'type', 'text/html', 'href', {audio}))
                      WHEN 'purchase' THEN array(
                        named_struct('rel', 'enclosure', 'type', 'audio/mpeg', 'href', 'ftp://old.example/x'))
                      ELSE array() END AS {link}) AS links""",
                f"CASE WHEN event_type IN ('purchase', 'signup') THEN {audio} END AS link",
                f"CASE WHEN event_type = 'error' AND value < 50 THEN {audio} END AS href",
                "CASE WHEN event_type = 'view' THEN date_trunc('SECOND', ts) END AS published_parsed",
                f"CASE WHEN value > 200 THEN 'some day' ELSE concat(date_format(ts, '{RFC}'),"
                " CASE WHEN event_type = 'click' THEN ' -0130' WHEN event_type = 'purchase' THEN ' GMT'"
                " ELSE ' +0000' END) END AS published",
                "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS fetched_at",
            )
            .withColumn("published_parsed", F.col("published_parsed").cast("timestamp_ntz"))
        )

    @cached_property
    def mixed_documents(self) -> DataFrame:
        """RSS documents of users with odd numbers, Atom documents of the others."""
        entries = self.raw("events").filter("user_id % 2 = 0").selectExpr(
            "user_id",
            "event_id",
            """concat('<entry><title type="text">', event_type, ' &amp; ', event_id, '</title>',
                CASE WHEN event_type = 'view' THEN concat('<link href="https://page.example/', event_id, '"/>') ELSE '' END,
                CASE WHEN event_type <> 'error' THEN
                  concat('<link rel="enclosure" type="audio/mpeg" href="https://cdn.example/', event_id, '.mp3"/>') ELSE '' END,
                CASE WHEN event_id % 3 = 0 THEN '<published>' ELSE '<updated>' END,
                date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), CASE WHEN event_id % 5 = 0 THEN '.250Z' ELSE '+00:00' END,
                CASE WHEN event_id % 3 = 0 THEN '</published>' ELSE '</updated>' END, '</entry>') AS entry""",
        )
        joined = ordered_concat(entries, ["user_id"], "event_id", "entry", "", "entries")
        atom = joined.selectExpr(
            "concat('https://feeds.example/', user_id, '.rss') AS url",
            """concat('<?xml version="1.0"?><feed xmlns="http://atom.example" xml:lang="en"><title>Feed ', user_id,
               '</title><link rel="self" type="application/atom+xml" href="https://self.example/"/>', entries, '</feed>') AS body""",
        )
        odd = F.regexp_extract("url", r"(\d+)\.rss$", 1).cast("long") % 2 == 1
        return self.feed_documents.filter(odd).unionByName(atom)

    @cached_property
    def loaded(self) -> DataFrame:
        """Episodes loaded earlier: the events that stand for a paid sign-up."""
        return (
            self.raw("events")
            .filter("event_type = 'signup' AND value > 100")
            .selectExpr(
                "event_id AS episode_id",
                "user_id AS podcast_id",
                "ts AS uploaded_at",
                "concat('https://cdn.example/view/', CAST(floor(value / 4) AS BIGINT), '.mp3') AS audio_url",
                "false AS transcribed",
                "ts AS published_at",
                "concat('Episode ', event_id) AS episode_title",
            )
        )

    @cached_property
    def known_podcasts(self) -> DataFrame:
        """Podcasts that exist, for the foreign-key rule."""
        solvent = self.raw("customer").filter("c_acctbal >= 0").selectExpr("c_custkey AS podcast_id")
        return self.podcasts.join(solvent, "podcast_id", "left_semi")

    @cached_property
    def feed_documents(self) -> DataFrame:
        """One RSS document per user with an item per event."""
        items = self.raw("events").selectExpr(
            "user_id",
            "event_id",
            f"""concat('<item><title>', event_type, ' &amp; ', event_id, '</title>',
                CASE WHEN event_type = 'view' THEN concat('<link>https://page.example/', event_id, '</link>') ELSE '' END,
                CASE WHEN event_type <> 'error' THEN
                  concat('<enclosure url="https://cdn.example/', event_id, '.mp3" type="audio/mpeg"/>') ELSE '' END,
                '<pubDate>', date_format(ts, '{RFC}'), ' +0000</pubDate></item>') AS item""",
        )
        joined = ordered_concat(items, ["user_id"], "event_id", "item", "", "items")
        return joined.selectExpr(
            "concat('https://feeds.example/', user_id, '.rss') AS url",
            """concat('<?xml version="1.0"?><rss version="2.0" xmlns:itunes="http://itunes.example"',
               ' xmlns:atom="http://atom.example"><channel><title>Feed ', user_id, '</title>',
               '<link>https://site.example/', user_id, '</link><language>EN</language>',
               '<pubDate>Sun, 16 Nov 2025 23:55:00 +0000</pubDate>',
               '<atom:link rel="self" type="application/rss+xml" href="https://self.example/', user_id, '.rss"/>',
               '<itunes:new-feed-url>https://moved.example/', user_id, '.rss</itunes:new-feed-url>',
               items, '</channel></rss>') AS body""",
        )

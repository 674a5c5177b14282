"""Plain SQL twins of the queries, over the given tables only."""

from __future__ import annotations

# White space as the engine strips it: Unicode spaces and the control separators.
WS = r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\p{Z}]"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def title_words(expr: str) -> str:
    runs = rf"regexp_extract_all(lower({expr}), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), '')"


def sentence_start(expr: str) -> str:
    lead = f"regexp_extract(substr({expr}, 1, 100), '(?s)^(.*[.!?]{WS}+)', 1)"
    rest = strip(f"substr({expr}, length({lead}) + 1)")
    return (
        rf"CASE WHEN regexp_matches({expr}, '^\p{{Ll}}') AND {lead} <> '' AND {rest} <> ''"
        f" THEN {rest} ELSE {expr} END"
    )


def cosine(a: str, b: str) -> str:
    double = lambda v: f"list_transform({v}, lambda x: x::DOUBLE)"
    return f"list_cosine_similarity({double(a)}, {double(b)})"


def distance(a: str, b: str) -> str:
    double = lambda v: f"list_transform({v}, lambda x: x::DOUBLE)"
    return f"list_distance({double(a)}, {double(b)})"


CTES = {
    "language": "SELECT n_nationkey::BIGINT AS language_id, n_name AS language_name FROM nation",
    "podcast": """SELECT c_custkey AS podcast_id, c_mktsegment AS podcast_name,
        c_nationkey::BIGINT AS language_id, TIMESTAMP '2020-01-01' AS uploaded_at,
        'https://feeds.example/' || c_custkey
          || CASE WHEN c_mktsegment = 'FURNITURE' THEN '.json' ELSE '.rss' END AS podcast_url
        FROM customer""",
    "episode": """SELECT o_orderkey AS episode_id, o_custkey AS podcast_id,
        o_orderdate + INTERVAL 1 DAY AS uploaded_at,
        'https://audio.example/' || o_orderkey || '.mp3' AS audio_url,
        CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS transcribed,
        o_orderdate AS published_at, 'Episode ' || o_orderkey AS episode_title FROM orders""",
    "topics": """SELECT p_partkey AS topic_id, CASE WHEN p_size > 25 THEN upper(p_name)
        ELSE p_name || '-' || lower(p_type) END AS topic_name FROM part""",
    "speakers": "SELECT s_suppkey AS speaker_id, s_name AS speaker_name FROM supplier",
    "episode_topics": "SELECT DISTINCT l_orderkey AS episode_id, l_partkey AS topic_id FROM lineitem",
    "episode_speakers": "SELECT DISTINCT l_orderkey AS episode_id, l_suppkey AS speaker_id FROM lineitem",
    "transcripts": """SELECT source AS podcast_id, doc_id::VARCHAR AS episode_id,
        text AS transcript_text FROM documents""",
    "summaries": """SELECT source AS podcast_id, doc_id::VARCHAR AS episode_id,
        CASE WHEN n_chars < 300 THEN NULL ELSE text END AS summary,
        CASE WHEN lang <> 'fr' THEN lang || '|' || source END AS topics,
        upper(source) AS speakers FROM documents""",
    "asked": """SELECT DISTINCT 'src' || CASE WHEN toxic = 1 THEN 'x' ELSE (doc_id % 20)::VARCHAR END AS podcast_id,
        doc_id::VARCHAR AS episode_id FROM labels""",
    "analyses": """SELECT doc_id AS episode_id,
        CASE WHEN n_chars < 200 THEN NULL
             ELSE [lang, source, lang, 'chars ' || (n_chars // 1000)] END AS topics,
        [CASE WHEN n_chars > 1500 THEN upper(source) ELSE source END,
         'Host ' || lang, upper('host ' || lang)] AS speakers FROM documents""",
    "known_topics": """SELECT lang AS topic_name, min(doc_id) AS topic_id FROM documents
        WHERE lang <> 'en' AND doc_id IN (SELECT doc_id FROM labels) GROUP BY lang""",
    "known_speakers": """SELECT 'SRC' || substr(source, 4, 9) AS speaker_name, min(doc_id) AS speaker_id
        FROM documents WHERE lang = 'de' GROUP BY 1""",
    "embedding": """SELECT v.vec_id // 5 AS episode_id, v.vec_id % 5 AS chunk_index,
        coalesce(substr(d.text, 2), '') AS chunk_text, v.embedding AS vec, v.label, v.vec_id
        FROM embeddings v LEFT JOIN documents d ON d.doc_id = v.vec_id""",
    "questions": "SELECT vec_id::BIGINT AS query_id, embedding AS qvec FROM embeddings WHERE vec_id % 20 = 0",
    "feeds": """SELECT c_custkey AS row_id, c_name AS podcast_name,
        TIMESTAMP '2020-01-01' + to_days(c_nationkey) + to_minutes(c_custkey % 1440)
          - CASE WHEN c_mktsegment = 'BUILDING' THEN INTERVAL 330 MINUTE ELSE INTERVAL 0 MINUTE END AS publish_date,
        'en-' || c_nationkey AS language_name,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'https://moved.example/' || c_custkey || '.rss'
          WHEN 'BUILDING' THEN 'https://self.example/' || (c_custkey % 200) || '.rss'
          WHEN 'MACHINERY' THEN 'https://site.example/' || c_nationkey || '.rss'
          WHEN 'FURNITURE' THEN 'https://site.example/' || c_custkey || '.xml' END AS podcast_url,
        CASE WHEN c_acctbal < 0 THEN 'title' WHEN c_acctbal > 9000 THEN 'published'
          WHEN c_nationkey = 3 THEN 'language' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'link' END AS reject_reason
        FROM customer""",
    "accepted_feeds": "SELECT * EXCLUDE (reject_reason) FROM feeds WHERE reject_reason IS NULL",
    "known_feeds": """SELECT 'https://moved.example/' || c_custkey || '.rss' AS podcast_url,
        c_name AS podcast_name, NULL::TIMESTAMP AS publish_date, n_name AS language_name
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 4000""",
    "added_feeds": """SELECT podcast_url, min(row_id) AS row_id FROM accepted_feeds
        WHERE podcast_url NOT IN (SELECT podcast_url FROM known_feeds) GROUP BY podcast_url""",
    "entry_base": """SELECT event_id, user_id, event_type, value, date_trunc('second', ts) AS second_ts,
        c_mktsegment AS podcast_name,
        'https://cdn.example/' || event_type || '/' || floor(value)::BIGINT || '.mp3' AS audio
        FROM events LEFT JOIN customer ON c_custkey = user_id""",
    "entries": """SELECT user_id AS podcast_id, podcast_name, event_id AS feed_pos,
        CASE WHEN value >= 2 THEN event_type || ' ' || event_id END AS episode_title,
        CASE WHEN event_type <> 'error' OR value < 50 THEN audio END AS audio_url,
        CASE WHEN value <= 200 THEN second_ts
             + CASE WHEN event_type = 'click' THEN INTERVAL 90 MINUTE ELSE INTERVAL 0 MINUTE END END AS text_date,
        CASE WHEN event_type = 'view' THEN second_ts ELSE text_date END AS published_at,
        CASE WHEN podcast_name IS NULL THEN 'podcast_name' WHEN value < 2 THEN 'title'
          WHEN audio_url IS NULL THEN 'audio_url' WHEN published_at IS NULL THEN 'published' END AS reject_reason
        FROM entry_base""",
    "loaded": """SELECT user_id AS podcast_id, ts AS uploaded_at,
        'https://cdn.example/view/' || floor(value / 4)::BIGINT || '.mp3' AS audio_url
        FROM events WHERE event_type = 'signup' AND value > 100""",
    "cutoffs": "SELECT podcast_id, max(uploaded_at) AS cutoff FROM loaded GROUP BY podcast_id",
    "gated": """SELECT e.*, cutoff, row_number() OVER (PARTITION BY podcast_id ORDER BY feed_pos) AS position
        FROM entries e LEFT JOIN cutoffs USING (podcast_id) WHERE e.podcast_name <> 'FURNITURE'""",
    "new_entries": """SELECT * FROM gated
        WHERE CASE WHEN cutoff IS NULL THEN position <= 20 ELSE published_at > cutoff END""",
    "first_poll": "SELECT * FROM gated WHERE position <= 20",
    "fresh": "SELECT * FROM new_entries WHERE reject_reason IS NULL",
    "winners": """SELECT audio_url, min((podcast_id, feed_pos)) AS row_key FROM fresh
        WHERE podcast_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
          AND audio_url NOT IN (SELECT audio_url FROM loaded) GROUP BY audio_url""",
    "outcomes": """SELECT f.*, CASE WHEN w.audio_url IS NULL THEN 'skipped' ELSE 'inserted' END AS outcome
        FROM fresh f LEFT JOIN winners w ON w.audio_url = f.audio_url AND w.row_key = (f.podcast_id, f.feed_pos)""",
    "doc_lines": """SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS pos,
        unnest(string_split(text, chr(10))) AS line, source FROM documents""",
    "spoken": f"""SELECT conv_id AS episode_id, role AS speaker, turn AS pos, {strip('text')} AS said
        FROM conversations""",
    "measured": """SELECT *, coalesce(sum(length(said) + 1) OVER (PARTITION BY episode_id, speaker ORDER BY pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
        FROM spoken WHERE said <> '' AND speaker <> ''""",
    "tokenised": f"""SELECT doc_id AS episode_id,
        list_filter(regexp_split_to_array(text, '{WS}+'), lambda t: t <> '') AS tokens FROM documents""",
    "topic_counts": f"""SELECT p.podcast_name, {title_words('t.topic_name')} AS topic_name,
        count(DISTINCT e.episode_id) AS episode_count
        FROM podcast p JOIN episode e USING (podcast_id) JOIN episode_topics et USING (episode_id)
        JOIN topics t USING (topic_id) GROUP BY 1, 2""",
    "speaker_counts": """SELECT p.podcast_name, s.speaker_name, count(DISTINCT e.episode_id) AS episode_count
        FROM podcast p JOIN episode e USING (podcast_id) JOIN episode_speakers es USING (episode_id)
        JOIN speakers s USING (speaker_id) GROUP BY 1, 2""",
    "facts": """SELECT p.podcast_name, e.episode_id, e.episode_title, e.published_at, e.transcribed, e.uploaded_at,
        count(DISTINCT et.topic_id) AS topic_count, count(DISTINCT es.speaker_id) AS speaker_count
        FROM episode e JOIN podcast p USING (podcast_id)
        LEFT JOIN episode_topics et ON et.episode_id = e.episode_id
        LEFT JOIN episode_speakers es ON es.episode_id = e.episode_id GROUP BY ALL""",
    "words": """SELECT podcast_id, episode_id,
        (length(transcript_text) - length(replace(transcript_text, ' ', '')) + 1)::INT AS word_count
        FROM transcripts""",
    "defective": """SELECT episode_id, chunk_index, label,
        NOT (label = 3 AND chunk_index = 4) AND NOT (label = 5 AND chunk_index = 2) AS fits FROM embedding""",
    "scored": f"""SELECT query_id, episode_id, chunk_index, chunk_text, {cosine('qvec', 'vec')} AS score
        FROM questions, embedding""",
    "hits": """SELECT *, row_number() OVER (PARTITION BY query_id
          ORDER BY score DESC, episode_id, chunk_index)::INT AS rank
        FROM scored WHERE score > 0.2 QUALIFY rank <= 5""",
    "exact_hits": """SELECT *, row_number() OVER (PARTITION BY query_id
          ORDER BY score DESC, episode_id, chunk_index)::INT AS rank FROM scored QUALIFY rank <= 5""",
    "found": f"""SELECT query_id, rank, h.episode_id, episode_title, podcast_name, published_at, chunk_index,
        {sentence_start('chunk_text')} AS chunk_text, round(score, 6) AS similarity
        FROM hits h JOIN episode e ON e.episode_id = h.episode_id JOIN podcast p USING (podcast_id)""",
    "anchors": """SELECT DISTINCT e.episode_id, e.vec AS qvec FROM embedding e
        WHERE chunk_index = 0""",
    "neighbours": f"""SELECT a.episode_id AS query_id, e.episode_id, max({cosine('a.qvec', 'e.vec')}) AS score
        FROM anchors a JOIN embedding e ON e.episode_id <> a.episode_id GROUP BY 1, 2""",
    "similar_hits": """SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, episode_id)::INT AS rank
        FROM neighbours QUALIFY rank <= 5""",
    "sizes": """SELECT count(*) AS n_vectors, count(DISTINCT vec_id // 5) AS n_shows,
        (SELECT count(DISTINCT conv_id) FROM conversations) AS n_talks FROM embeddings""",
    "chats": """SELECT conv_id * n_shows + episode_id AS query_id, conv_id, episode_id, embedding AS qvec
        FROM (SELECT DISTINCT conv_id FROM conversations) talks CROSS JOIN sizes
        JOIN (SELECT DISTINCT vec_id // 5 AS episode_id FROM embeddings) shows
          ON conv_id % n_shows = episode_id OR conv_id % n_talks = episode_id % n_talks
        JOIN embeddings ON vec_id = (conv_id * 7) % n_vectors""",
    "told": f"""SELECT query_id, chunk_index, chunk_text, row_number() OVER (PARTITION BY query_id
          ORDER BY {cosine('qvec', 'vec')} DESC, chunk_index) AS rank
        FROM chats JOIN embedding USING (episode_id) QUALIFY rank <= 5""",
    "context": """SELECT q.query_id, coalesce(string_agg('[Chunk ' || chunk_index || ']: ' || chunk_text,
          chr(10) || chr(10) ORDER BY rank), '') AS context
        FROM chats q LEFT JOIN told f ON f.query_id = q.query_id GROUP BY 1""",
    "recommended": """SELECT a.query_id, coalesce(chr(10) || chr(10) || '**Similar Episodes Available:**' || chr(10)
          || string_agg('- ' || episode_title || ' (' || podcast_name || ') - Similarity: '
               || printf('%.1f', score * 100) || '%' || chr(10), '' ORDER BY rank), '') AS similar_episodes
        FROM (SELECT DISTINCT vec_id // 5 AS query_id FROM embeddings) a
        LEFT JOIN similar_hits s ON s.query_id = a.query_id
        LEFT JOIN episode e ON e.episode_id = s.episode_id LEFT JOIN podcast p USING (podcast_id) GROUP BY 1""",
    "turn_text": """SELECT conv_id AS episode_id, string_agg(text, ' ' ORDER BY turn) AS transcript_text
        FROM conversations GROUP BY 1""",
}

# Which other parts a part is built from.
NEEDS = {
    "accepted_feeds": ["feeds"],
    "added_feeds": ["accepted_feeds", "known_feeds"],
    "entries": ["entry_base"],
    "cutoffs": ["loaded"],
    "gated": ["entries", "cutoffs"],
    "new_entries": ["gated"],
    "first_poll": ["gated"],
    "fresh": ["new_entries"],
    "winners": ["fresh", "loaded"],
    "outcomes": ["fresh", "winners"],
    "measured": ["spoken"],
    "topic_counts": ["podcast", "episode", "episode_topics", "topics"],
    "speaker_counts": ["podcast", "episode", "episode_speakers", "speakers"],
    "facts": ["podcast", "episode", "episode_topics", "episode_speakers"],
    "words": ["transcripts"],
    "defective": ["embedding"],
    "scored": ["questions", "embedding"],
    "hits": ["scored"],
    "exact_hits": ["scored"],
    "found": ["hits", "episode", "podcast"],
    "anchors": ["embedding"],
    "neighbours": ["anchors", "embedding"],
    "similar_hits": ["neighbours"],
    "chats": ["sizes"],
    "told": ["chats", "embedding"],
    "context": ["chats", "told"],
    "recommended": ["similar_hits", "episode", "podcast"],
}


def _sql(select: str, *parts: str) -> str:
    """A statement with the parts it names, and theirs, in front.

    A statement that begins with a comma goes on with parts of its own.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in NEEDS.get(name, []):
                add(need)
            ordered.append(name)

    for name in parts:
        add(name)
    # "MATERIALIZED" keeps a part that is used twice from being computed twice.
    with_clause = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in ordered)
    return f"WITH {with_clause}\n{select}"


def _table_sum(name: str, table: str, key: str, where: str = "true") -> str:
    return (
        f"SELECT '{name}' AS table_name, count(*) AS rows, sum({key})::BIGINT AS key_sum FROM {table} WHERE {where}"
    )


_GONE = "(SELECT podcast_id FROM podcast WHERE podcast_name = 'FURNITURE')"
_GONE_EPISODES = f"(SELECT episode_id FROM episode WHERE podcast_id IN {_GONE})"
_LOST = "(SELECT n_nationkey FROM nation WHERE n_regionkey = 2)"

_LOADED_ROW = """SELECT f.podcast_id, TIMESTAMP '2024-02-01' AS uploaded_at, f.audio_url, false AS transcribed,
    f.published_at, f.episode_title FROM"""

ORACLE: dict[str, str] = {
    "list_podcasts": _sql("SELECT podcast_id, podcast_name, podcast_url FROM podcast", "podcast"),
    "transcripts_strict": _sql(
        """SELECT source AS podcast_id, doc_id::VARCHAR AS episode_id,
           string_agg(line, ' ' ORDER BY pos) AS transcript_text FROM doc_lines WHERE line <> '' GROUP BY 1, 2""",
        "doc_lines",
    ),
    "transcripts_keep_empty": _sql(
        """SELECT source AS podcast_id, doc_id::VARCHAR AS episode_id,
           string_agg(line, ' ' ORDER BY pos) AS transcript_text FROM doc_lines GROUP BY 1, 2""",
        "doc_lines",
    ),
    "transcripts_any_format": _sql(
        """SELECT podcast_id, episode_id, transcript_text || chr(10) AS transcript_text FROM transcripts
           UNION ALL SELECT podcast_id || '-lines', episode_id, transcript_text FROM transcripts""",
        "transcripts",
    ),
    "assemble_transcripts": _sql("SELECT * FROM turn_text", "turn_text"),
    "segments_tolerant": """SELECT conv_id AS episode_id, turn * 2.0::DOUBLE AS start_time,
        turn * 2.0::DOUBLE + 1.5 AS end_time, role AS speaker, text FROM conversations WHERE role <> 'system'""",
    "stored_transcripts": _sql("SELECT * FROM transcripts", "transcripts"),
    "stored_summaries": _sql(
        """SELECT podcast_id, episode_id, coalesce(summary, '') AS summary, coalesce(topics, '') AS topics,
           speakers FROM summaries""",
        "summaries",
    ),
    "transcript_coverage": """SELECT o_orderkey AS episode_id, o_orderkey IN (SELECT doc_id FROM documents)
        AS has_transcript FROM orders""",
    "registered_datasets": _sql(
        """SELECT 'show' AS podcast_id, 'transcripts' AS dataset, count(*) AS rows, count(*) AS episodes,
             sum(length(transcript_text))::BIGINT AS characters FROM turn_text
           UNION ALL SELECT 'show', 'segments', count(*), count(DISTINCT conv_id), sum(length(text))::BIGINT
             FROM conversations
           UNION ALL SELECT 'show', 'summaries', count(*), count(*), sum(length(transcript_text))::BIGINT
             FROM turn_text""",
        "turn_text",
    ),
    "lookup_transcripts": _sql(
        """SELECT a.podcast_id, a.episode_id,
             CASE WHEN length(transcript_text) < 500 THEN '' ELSE transcript_text END AS transcript_text,
             CASE WHEN transcript_text IS NULL THEN 'missing' WHEN length(transcript_text) < 500 THEN 'empty'
               ELSE 'found' END AS status
           FROM asked a LEFT JOIN transcripts t USING (podcast_id, episode_id)""",
        "asked", "transcripts",
    ),
    "lookup_summaries": _sql(
        """SELECT a.podcast_id, a.episode_id, summary, topics, speakers,
             CASE WHEN speakers IS NULL THEN 'missing' WHEN summary IS NULL THEN 'empty' ELSE 'found' END AS status
           FROM asked a LEFT JOIN summaries s USING (podcast_id, episode_id)""",
        "asked", "summaries",
    ),
    "parse_feed_headers": """SELECT DISTINCT 'https://feeds.example/' || user_id || '.rss' AS url,
        'Feed ' || user_id AS title, 'Sun, 16 Nov 2025 23:55:00 +0000' AS published, 'EN' AS language,
        'https://site.example/' || user_id AS link, 'https://moved.example/' || user_id || '.rss' AS new_feed_url,
        'https://self.example/' || user_id || '.rss' AS self_href, 2 AS links FROM events""",
    "parse_feed_entries": """SELECT 'https://feeds.example/' || user_id || '.rss' AS url,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS feed_pos,
        event_type || ' & ' || event_id AS title,
        CASE WHEN event_type = 'view' THEN 'https://page.example/' || event_id END AS link,
        strftime(ts, '%a, %d %b %Y %H:%M:%S +0000') AS published,
        CASE WHEN event_type <> 'error' THEN 'https://cdn.example/' || event_id || '.mp3' END AS audio_href
        FROM events""",
    "parse_mixed_feeds": """SELECT 'https://feeds.example/' || user_id || '.rss' AS url,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS feed_pos,
        event_type || ' & ' || event_id AS title,
        CASE WHEN event_type = 'view' THEN 'https://page.example/' || event_id END AS link,
        date_trunc('second', ts) AS published_at,
        CASE WHEN event_type <> 'error' THEN 'https://cdn.example/' || event_id || '.mp3' END AS audio_url
        FROM events""",
    "gate_feed_urls": _sql(
        """SELECT *, CASE WHEN url IS NULL OR url = '' THEN 'empty url'
             WHEN NOT (suffix(url, '.rss') OR suffix(url, '.xml')) THEN 'not a feed url' END AS reject_reason
           FROM (SELECT page_id, url FROM pages UNION ALL SELECT -1 - podcast_id, podcast_url FROM podcast)""",
        "podcast",
    ),
    "validate_feeds": _sql("SELECT * FROM accepted_feeds", "accepted_feeds"),
    "rejected_feeds": _sql("SELECT row_id, reject_reason FROM feeds WHERE reject_reason IS NOT NULL", "feeds"),
    "upsert_podcasts": _sql(
        """SELECT podcast_url, podcast_name, publish_date, language_name FROM known_feeds
           UNION ALL SELECT podcast_url, podcast_name, publish_date, language_name
           FROM accepted_feeds JOIN added_feeds USING (podcast_url, row_id)""",
        "added_feeds",
    ),
    "upsert_languages": _sql(
        "SELECT n_name AS language_name FROM nation UNION SELECT language_name FROM accepted_feeds",
        "accepted_feeds",
    ),
    "upsert_podcast_status": _sql(
        """SELECT podcast_url, f.row_id, CASE WHEN a.row_id IS NULL THEN 'duplicate' ELSE 'added' END AS status
           FROM accepted_feeds f LEFT JOIN added_feeds a USING (podcast_url, row_id)""",
        "added_feeds",
    ),
    "ingest_cutoffs": _sql("SELECT podcast_id, max(uploaded_at) AS cutoff FROM episode GROUP BY 1", "episode"),
    "ingest_cutoffs_by_date": _sql(
        "SELECT podcast_id, max(published_at) - INTERVAL 3 DAY AS cutoff FROM episode GROUP BY 1", "episode"
    ),
    "select_new_episodes": _sql("SELECT podcast_id, feed_pos, published_at FROM new_entries", "new_entries"),
    "entry_audio_links": _sql("SELECT podcast_id, feed_pos, audio_url FROM entries", "entries"),
    "validate_episodes": _sql(
        """SELECT podcast_id, podcast_name, feed_pos, episode_title, audio_url, published_at, false AS transcribed
           FROM entries WHERE reject_reason IS NULL""",
        "entries",
    ),
    "rejected_episodes": _sql(
        "SELECT podcast_id, feed_pos, reject_reason FROM entries WHERE reject_reason IS NOT NULL", "entries"
    ),
    "mail_dates": _sql("SELECT feed_pos, text_date AS published_at FROM entries", "entries"),
    "iso_dates": """SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('minute', ts) + INTERVAL 90 MINUTE
          WHEN 'view' THEN date_trunc('minute', ts) WHEN 'purchase' THEN date_trunc('second', ts)
          WHEN 'signup' THEN date_trunc('minute', ts) END AS published_at FROM events""",
    "podcasts_with_episodes": _sql(
        """SELECT podcast_id, podcast_name, count(*) AS entries,
             count(*) FILTER (reject_reason IS NULL) AS valid_episodes
           FROM entries GROUP BY 1, 2 HAVING valid_episodes > 0""",
        "entries",
    ),
    "load_episodes": _sql(f"{_LOADED_ROW} outcomes f WHERE outcome = 'inserted'", "outcomes"),
    "load_outcomes": _sql("SELECT podcast_id, feed_pos, audio_url, outcome FROM outcomes", "outcomes"),
    "load_stats": _sql(
        """SELECT podcast_id, podcast_name, 1::BIGINT AS total_podcasts, count(*) AS total_episodes,
             count(*) FILTER (outcome = 'inserted') AS inserted_episodes,
             count(*) FILTER (outcome = 'skipped') AS skipped_episodes FROM outcomes GROUP BY 1, 2
           UNION ALL SELECT -1, 'all', count(DISTINCT podcast_id), count(*),
             count(*) FILTER (outcome = 'inserted'), count(*) FILTER (outcome = 'skipped') FROM outcomes""",
        "outcomes",
    ),
    "incremental_publish": _sql(
        """, steps AS (SELECT CASE WHEN transcribed THEN 1 WHEN NOT transcribed THEN 2 ELSE 3 END AS step, episode_id FROM episode)
           SELECT v::INT AS version, count(*) FILTER (step = v) AS written, count(*) AS episodes,
             sum(episode_id)::BIGINT AS key_sum, (SELECT count(*) FROM customer) AS podcasts
           FROM steps, range(1, 4) t(v) WHERE step <= v GROUP BY v""",
        "episode",
    ),
    "load_repeated_documents": """SELECT 'https://feeds.example/' || user_id || '.rss' AS podcast_name,
          count(*) AS total_episodes, count(*) AS inserted_episodes, 0::BIGINT AS skipped_episodes, count(*) AS stored
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events)
        WHERE pos <= 5 AND event_type <> 'error' GROUP BY user_id""",
    "ingest_stream": _sql(
        f"""{_LOADED_ROW} first_poll f JOIN (
              SELECT audio_url, min((podcast_id, feed_pos)) AS row_key FROM first_poll
              WHERE reject_reason IS NULL AND podcast_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
              GROUP BY audio_url) w
            ON w.audio_url = f.audio_url AND w.row_key = (f.podcast_id, f.feed_pos)
            WHERE f.reject_reason IS NULL""",
        "first_poll",
    ),
    "cascade_delete": _sql(
        " UNION ALL ".join(
            [
                _table_sum("podcast", "podcast", "podcast_id", f"podcast_id NOT IN {_GONE}"),
                _table_sum("episode", "episode", "episode_id", f"podcast_id NOT IN {_GONE}"),
                _table_sum("language", "language", "language_id", f"language_id NOT IN {_LOST}"),
                *[
                    _table_sum(n, t, "episode_id", f"episode_id NOT IN {_GONE_EPISODES}")
                    for n, t in (
                        ("episode_topics", "episode_topics"),
                        ("episode_speakers", "episode_speakers"),
                        ("episode_embedding", "embedding"),
                    )
                ],
                _table_sum(
                    "podcast without language", "podcast", "podcast_id",
                    f"podcast_id NOT IN {_GONE} AND language_id IN {_LOST}",
                ),
            ]
        ),
        "podcast", "episode", "language", "episode_topics", "episode_speakers", "embedding",
    ),
    "backlog_count": _sql("SELECT count(*) AS backlog FROM episode WHERE transcribed = false", "episode"),
    "work_list": _sql(
        """SELECT episode_id, podcast_id, podcast_name, episode_title, audio_url, e.uploaded_at
           FROM episode e JOIN podcast p USING (podcast_id) WHERE transcribed = false
           ORDER BY e.uploaded_at, episode_id LIMIT 100""",
        "episode", "podcast",
    ),
    "guard_required": _sql(
        """SELECT event_id AS episode_id, CASE WHEN event_type IN ('purchase', 'signup') AND podcast_name <> ''
             THEN 'ready' ELSE 'error' END AS status FROM entry_base""",
        "entry_base",
    ),
    "plan_slices": """SELECT *, least(start_ms + 120000, duration_ms) AS end_ms,
          (least(start_ms + 120000, duration_ms) - start_ms) / 1000.0::DOUBLE AS duration_s
        FROM (SELECT doc_id AS episode_id, length(text) * 250 AS duration_ms,
                unnest(range(0, ceil(length(text) * 250 / 120000)::BIGINT)) AS slice_index,
                slice_index * 120000 AS start_ms FROM documents)""",
    "stitch_segments": """WITH slices AS (
          SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines,
            coalesce(sum(length(text) * 0.213::DOUBLE) OVER (PARTITION BY conv_id ORDER BY turn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offset_s FROM conversations),
        cut AS (SELECT conv_id, turn, role, offset_s, unnest(range(0, len(lines))) AS pos,
          unnest(lines) AS text FROM slices)
        SELECT conv_id AS episode_id, round(offset_s + pos * 1.5::DOUBLE, 6) AS start_time,
          round(offset_s + pos * 1.5::DOUBLE + 1, 6) AS end_time, role AS speaker, text,
          turn AS slice_index, pos::INT AS pos FROM cut""",
    "assemble_text": f"""SELECT conv_id AS episode_id,
        CASE WHEN bool_or(role = 'system') THEN 'failed' ELSE 'success' END AS status,
        CASE WHEN NOT bool_or(role = 'system') THEN {strip("string_agg(text, ' ' ORDER BY turn)")} END
          AS transcript_text FROM conversations GROUP BY 1""",
    "apply_transcribed": _sql(
        """SELECT episode_id, CASE WHEN episode_id IN (SELECT doc_id FROM documents) THEN 'true'
             ELSE transcribed::VARCHAR END AS transcribed FROM episode""",
        "episode",
    ),
    "transcribed_in_buckets": """SELECT o_orderkey AS episode_id, CASE WHEN o_orderkey IN
          (SELECT doc_id FROM labels WHERE toxic = 1) OR o_orderstatus = 'F' THEN 'true'
          WHEN o_orderstatus = 'O' THEN 'false' END AS transcribed, true AS as_reported FROM orders""",
    "embeddings_in_buckets": _sql(
        """SELECT episode_id, chunk_index, chunk_text, 64 AS numbers, true AS as_reported FROM embedding
             WHERE episode_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
           UNION ALL SELECT DISTINCT episode_id, 0, 'new', 1, true FROM embedding
             WHERE episode_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
        "embedding",
    ),
    "route_outcomes": """SELECT CASE WHEN toxic = 1 THEN 'failed' WHEN quality = 1 THEN 'process'
        ELSE 'skipped' END AS route, count(*) AS episodes FROM labels GROUP BY 1""",
    "speaker_samples": _sql(
        f"""SELECT episode_id, speaker, min(pos) AS first_pos,
             {strip("substr(string_agg(said, ' ' ORDER BY pos), 1, 500)")} AS sample
           FROM measured WHERE used < 500 GROUP BY 1, 2""",
        "measured",
    ),
    "analysis_requests": _sql(
        f"""SELECT *, transcript || speaker_block AS request FROM (
              SELECT doc_id AS episode_id, substr(text, 1, 10000) AS transcript,
                coalesce(chr(10) || chr(10) || 'SPEAKER SAMPLES (for identification):' || chr(10)
                  || string_agg(chr(10) || 'Speaker ' || speaker || ' said:' || chr(10) || '"' || sample || '"'
                       || chr(10), '' ORDER BY first_pos), '') AS speaker_block
              FROM documents LEFT JOIN (
                SELECT episode_id, speaker, min(pos) AS first_pos,
                  {strip("substr(string_agg(said, ' ' ORDER BY pos), 1, 500)")} AS sample
                FROM measured WHERE used < 500 GROUP BY 1, 2) s ON s.episode_id = doc_id
              GROUP BY 1, 2)""",
        "measured",
    ),
    "parse_analysis": """SELECT doc_id AS episode_id,
        CASE WHEN n_chars < 500 THEN 'failed' ELSE 'parsed' END AS status,
        CASE WHEN n_chars < 500 THEN NULL WHEN n_chars < 700 THEN '' WHEN n_chars < 1000 THEN lang
          ELSE lang || '|' || source END AS topics,
        CASE WHEN n_chars < 500 THEN NULL WHEN n_chars < 1000 THEN '' ELSE 'about ' || lang END AS summary,
        CASE WHEN n_chars < 500 THEN NULL WHEN n_chars < 1000 THEN '' ELSE source || '|Host' END AS speakers
        FROM documents""",
    "upsert_topics": _sql(
        """SELECT episode_id, unnest(topics) AS topic_name FROM analyses
           UNION SELECT topic_id, topic_name FROM known_topics""",
        "analyses", "known_topics",
    ),
    "upsert_speakers": _sql(
        """, named AS (SELECT episode_id, unnest(range(0, len(speakers))) AS pos, unnest(speakers) AS name
             FROM analyses),
           spelling AS (SELECT lower(name) AS key, arg_min(name, (episode_id, pos)) AS first_name
             FROM named GROUP BY 1)
           SELECT DISTINCT episode_id, coalesce(k.speaker_name, first_name) AS speaker_name FROM named
           JOIN spelling ON key = lower(name) LEFT JOIN known_speakers k ON lower(k.speaker_name) = key
           UNION SELECT speaker_id, speaker_name FROM known_speakers""",
        "analyses", "known_speakers",
    ),
    "analysis_status": _sql(
        """SELECT episode_id, CASE WHEN topics IS NULL THEN 'topics missing'
             WHEN episode_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O'))
             THEN 'episode missing' ELSE 'stored' END AS status FROM analyses""",
        "analyses",
    ),
    "store_analysis": _sql(
        """, storable AS (SELECT * FROM analyses WHERE topics IS NOT NULL
             AND episode_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O'))),
           topic_links AS (SELECT episode_id, unnest(topics) AS name FROM storable
             UNION SELECT topic_id, topic_name FROM known_topics),
           named AS (SELECT episode_id, unnest(range(0, len(speakers))) AS pos, unnest(speakers) AS name
             FROM storable),
           spelling AS (SELECT lower(name) AS key, arg_min(name, (episode_id, pos)) AS first_name
             FROM named GROUP BY 1),
           speaker_links AS (SELECT DISTINCT episode_id, coalesce(k.speaker_name, first_name) AS name FROM named
             JOIN spelling ON key = lower(named.name) LEFT JOIN known_speakers k ON lower(k.speaker_name) = key
             UNION SELECT speaker_id, speaker_name FROM known_speakers)
           SELECT name, count(*) AS episodes, 'topic' AS kind FROM topic_links GROUP BY 1
           UNION ALL SELECT name, count(*), 'speaker' FROM speaker_links GROUP BY 1""",
        "analyses", "known_topics", "known_speakers",
    ),
    "episode_analysis": _sql(
        """, t AS (SELECT episode_id, string_agg(topic_name, '|' ORDER BY topic_name) AS topics
             FROM episode_topics JOIN topics USING (topic_id) GROUP BY 1),
           s AS (SELECT episode_id, string_agg(speaker_name, '|' ORDER BY speaker_name) AS speakers
             FROM episode_speakers JOIN speakers USING (speaker_id) GROUP BY 1)
           SELECT episode_id, coalesce(topics, '') AS topics, coalesce(speakers, '') AS speakers,
             NULL::VARCHAR AS summary
           FROM episode LEFT JOIN t USING (episode_id) LEFT JOIN s USING (episode_id)""",
        "episode", "episode_topics", "topics", "episode_speakers", "speakers",
    ),
    "gate_transcripts": f"""SELECT doc_id::VARCHAR AS episode_id,
        CASE WHEN {strip('text')} = '' THEN 'empty' WHEN length({strip('text')}) < 100 THEN 'too short' END
          AS reject_reason FROM documents""",
    "chunk_transcripts": _sql(
        """SELECT episode_id, i::INT AS chunk_index,
             array_to_string(tokens[i * 256 + 1 : i * 256 + 512], ' ') AS chunk_text,
             len(tokens[i * 256 + 1 : i * 256 + 512])::INT AS token_count, (i * 256)::INT AS start_token,
             (i * 256 + 512)::INT AS end_token
           FROM (SELECT episode_id, tokens, unnest(range(0, ceil(len(tokens) / 256)::BIGINT)) AS i FROM tokenised)""",
        "tokenised",
    ),
    "embed_chunks": _sql(
        """SELECT episode_id, unnest(range(0, ceil(len(tokens) / 256)::BIGINT))::INT AS chunk_index,
             1536 AS dimensions, 1.0::DOUBLE AS length FROM tokenised""",
        "tokenised",
    ),
    "embed_batches": _sql(
        """, pieces AS (SELECT episode_id, i AS chunk_index, array_to_string(tokens[i * 256 + 1 : i * 256 + 512], ' ') AS piece
             FROM (SELECT episode_id, tokens, unnest(range(0, ceil(len(tokens) / 256)::BIGINT)) AS i FROM tokenised)),
           counted AS (SELECT episode_id, chunk_index, contains(piece, 'zz') AS refused, list_transform(range(0, 26),
             lambda k: length(piece) - length(replace(piece, chr((97 + k)::INT), ''))) AS letters FROM pieces),
           bad AS (SELECT episode_id, count(*) AS failed_chunks FROM counted WHERE refused GROUP BY 1)
           SELECT episode_id, chunk_index, 26 AS dimensions,
             list_sum(list_transform(letters, lambda x, i: x * i))::BIGINT AS weighed,
             list_sum(list_transform(letters, lambda x: x * x))::BIGINT AS squares, NULL::BIGINT AS failed_chunks
           FROM counted WHERE episode_id NOT IN (SELECT episode_id FROM bad)
           UNION ALL SELECT episode_id, NULL, NULL, NULL, NULL, failed_chunks FROM bad""",
        "tokenised",
    ),
    "validate_embeddings": _sql(
        """SELECT doc_id AS episode_id, count(d.fits) AS chunks, coalesce(bool_and(d.fits), false) AS is_valid
           FROM documents LEFT JOIN defective d ON d.episode_id = doc_id GROUP BY 1""",
        "defective",
    ),
    "valid_chunks": _sql(
        """SELECT episode_id, chunk_index, label FROM defective
           WHERE episode_id NOT IN (SELECT episode_id FROM defective WHERE NOT fits)""",
        "defective",
    ),
    "replace_embeddings": _sql(
        """, fresh AS (SELECT * FROM embedding WHERE label < 3
             AND episode_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O')))
           SELECT episode_id, chunk_index, chunk_text, len(vec)::INT AS numbers,
             round(list_sum(list_transform(vec, lambda x: x::DOUBLE)), 5) AS total,
             round(vec[1]::DOUBLE, 6) AS first_number FROM embedding
           WHERE episode_id NOT IN (SELECT episode_id FROM fresh)
           UNION ALL SELECT episode_id, chunk_index, 'new ' || label, len(vec)::INT,
             round(list_sum(list_transform(vec, lambda x: x::DOUBLE)), 5), round(vec[1]::DOUBLE, 6) FROM fresh""",
        "embedding",
    ),
    "search_chunks": _sql("SELECT * FROM found", "found"),
    "search_chunks_tiled": _sql("SELECT * FROM found", "found"),
    "search_episodes": _sql(
        """, best AS (SELECT query_id, episode_id, max(score) AS score FROM scored GROUP BY 1, 2),
           placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, episode_id)::INT AS rank
             FROM best QUALIFY rank <= 5)
           SELECT query_id, rank, episode_id, episode_title, published_at, podcast_id, podcast_name,
             round(score, 6) AS similarity_score
           FROM placed JOIN episode USING (episode_id) JOIN podcast USING (podcast_id)""",
        "scored", "episode", "podcast",
    ),
    "search_within": _sql(
        f""", asked AS (SELECT episode_id, arg_max(vec, chunk_index) AS qvec FROM embedding GROUP BY 1),
           s AS (SELECT episode_id, chunk_index, chunk_text, {cosine('qvec', 'vec')} AS score
             FROM asked JOIN embedding USING (episode_id))
           SELECT episode_id AS query_id, row_number() OVER (PARTITION BY episode_id
               ORDER BY score DESC, chunk_index)::INT AS rank, episode_id, chunk_index, chunk_text,
             round(score, 6) AS similarity_score FROM s QUALIFY rank <= 3""",
        "embedding",
    ),
    "similar_episodes": _sql(
        """SELECT query_id, rank, episode_id, episode_title, published_at, podcast_id, podcast_name,
             round(score, 6) AS similarity_score
           FROM similar_hits JOIN episode USING (episode_id) JOIN podcast USING (podcast_id)""",
        "similar_hits", "episode", "podcast",
    ),
    "search_every_chunk": _sql(
        f""", pairs AS (SELECT q.episode_id * 5 + q.chunk_index AS query_id, e.episode_id, e.chunk_index,
             {cosine('q.vec', 'e.vec')} AS score FROM embedding q, embedding e)
           , placed AS (SELECT *, row_number() OVER (PARTITION BY query_id
             ORDER BY score DESC, episode_id, chunk_index)::INT AS rank FROM pairs WHERE score > 0.2 QUALIFY rank <= 3)
           SELECT query_id, rank, episode_id, chunk_index, round(score, 6) AS similarity
           FROM placed WHERE episode_id IN (SELECT episode_id FROM episode)""",
        "embedding", "episode",
    ),
    "ann_recall": "SELECT count(*) * 5 AS hits, true AS recall_reached FROM embeddings WHERE vec_id % 20 = 0",
    "ann_search_all_cells": _sql(
        "SELECT query_id, rank, episode_id, chunk_index, round(score, 6) AS similarity FROM exact_hits", "exact_hits"
    ),
    "embedding_coverage": """SELECT o_orderkey AS episode_id,
        o_orderkey IN (SELECT vec_id // 5 FROM embeddings) AS has_embeddings FROM orders""",
    "search_by_distance": _sql(
        f""", s AS (SELECT query_id, episode_id, chunk_index, {distance('qvec', 'vec')} AS score
             FROM questions, embedding)
           SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, episode_id, chunk_index)::INT AS rank,
             episode_id, chunk_index, podcast_name, round(score, 6) AS distance
           FROM s JOIN episode USING (episode_id) JOIN podcast USING (podcast_id) QUALIFY rank <= 5""",
        "questions", "embedding", "episode", "podcast",
    ),
    "sentence_starts": f"""SELECT doc_id::VARCHAR AS episode_id, {sentence_start('substr(text, 2)')} AS chunk_text
        FROM documents""",
    "chunk_context": _sql("SELECT * FROM context", "context"),
    "similar_context": _sql("SELECT * FROM recommended", "recommended"),
    "message_context": _sql(
        """, wanted AS (SELECT conv_id, turn, query_id, episode_id,
             role = 'system' OR turn = 2 OR contains(lower(text), 'similar') OR contains(lower(text), 'like this')
             OR contains(lower(text), 'recommend') OR contains(lower(text), 'related episodes') AS wants_similar
           FROM conversations JOIN chats USING (conv_id))
           SELECT conv_id, turn, w.query_id, wants_similar, coalesce(context, '') AS context,
             CASE WHEN wants_similar THEN coalesce(similar_episodes, '') ELSE '' END AS similar_episodes
           FROM wanted w LEFT JOIN context c ON c.query_id = w.query_id
           LEFT JOIN recommended r ON r.query_id = w.episode_id""",
        "context", "recommended",
    ),
    "chat_request": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS position, role, text
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations)
        WHERE back <= 3
        UNION ALL SELECT DISTINCT conv_id, 4, 'user', 'And what about ' || conv_id || '?' FROM conversations""",
    "recent_turns": """SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT
          AS position
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations)
        WHERE back <= 3""",
    "keyword_search": """WITH k AS (SELECT word, min(item_id * 100000 + pos - 1) AS query_id FROM (
          SELECT item_id, generate_subscripts(words, 1) AS pos, unnest(words) AS word
          FROM (SELECT item_id, string_split(lower(text), ' ') AS words FROM benchmark)) WHERE word <> '' GROUP BY word),
        t AS (SELECT doc_id AS episode_id, 'The ' || doc_id || ' and more' AS episode_title, text FROM documents)
        SELECT query_id, episode_id, episode_title, contains(lower(episode_title), word) AS in_title,
          contains(lower(text), word) AS in_transcript FROM k JOIN t
        ON contains(lower(episode_title), word) OR contains(lower(text), word)""",
    "filter_episodes": _sql(
        """SELECT episode_id, podcast_id, episode_title, published_at FROM episode
           WHERE published_at BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-06-30'
             AND podcast_id IN (SELECT podcast_id FROM podcast WHERE podcast_name IN ('BUILDING', 'MACHINERY'))
             AND episode_id IN (SELECT episode_id FROM episode_topics JOIN topics USING (topic_id)
               WHERE topic_name IN ('RED WIDGET', 'BLUE BOLT', 'SMALL RING', 'HOT GEAR'))
             AND episode_id IN (SELECT episode_id FROM episode_speakers JOIN speakers USING (speaker_id)
               WHERE speaker_name <= 'Supplier#000000039')""",
        "episode", "podcast", "episode_topics", "topics", "episode_speakers", "speakers",
    ),
    "episodes_with_podcast": _sql(
        """SELECT e.* REPLACE (e.transcribed::VARCHAR AS transcribed), p.podcast_name,
             p.language_id, p.uploaded_at AS podcast_uploaded_at, p.podcast_url
           FROM episode e JOIN podcast p ON p.podcast_id = e.podcast_id""",
        "episode", "podcast",
    ),
    "content_counts": _sql(
        """SELECT (SELECT count(*) FROM podcast) AS podcasts, count(*) AS episodes,
             count(*) FILTER (transcribed) AS transcripts FROM episode""",
        "episode", "podcast",
    ),
    "content_counts_by_name": _sql(
        """SELECT podcast_name, count(DISTINCT p.podcast_id) AS podcasts, count(episode_id) AS episodes,
             count(*) FILTER (transcribed) AS transcripts
           FROM podcast p LEFT JOIN episode e USING (podcast_id) GROUP BY 1""",
        "episode", "podcast",
    ),
    "episodes_per_podcast": _sql(
        """SELECT podcast_name, count(episode_id) AS episode_count
           FROM podcast LEFT JOIN episode USING (podcast_id) GROUP BY 1""",
        "episode", "podcast",
    ),
    "topics_per_podcast": _sql("SELECT * FROM topic_counts", "topic_counts"),
    "top_topics": _sql(
        """SELECT *, row_number() OVER (PARTITION BY podcast_name ORDER BY episode_count DESC, topic_name)::INT AS rank
           FROM topic_counts QUALIFY rank <= 3""",
        "topic_counts",
    ),
    "published_timeline": _sql(
        """SELECT podcast_name, published_at, episode_title, episode_id
           FROM podcast JOIN episode USING (podcast_id) WHERE published_at IS NOT NULL""",
        "episode", "podcast",
    ),
    "cumulative_published": _sql(
        """SELECT episode_id, published_at, episode_title, podcast_name, row_number() OVER (
             PARTITION BY podcast_name ORDER BY published_at, episode_id) AS cumulative_episodes
           FROM podcast JOIN episode USING (podcast_id)
           WHERE published_at >= TIMESTAMP '1999-03-31' - INTERVAL 1 MONTH""",
        "episode", "podcast",
    ),
    "topics_per_episode": _sql(
        """SELECT podcast_name, episode_id, episode_title, published_at,
             transcribed::VARCHAR AS transcribed, topic_count FROM facts""",
        "facts",
    ),
    "episode_details": _sql("SELECT * REPLACE (transcribed::VARCHAR AS transcribed) FROM facts", "facts"),
    "topic_frequency": _sql(
        """SELECT *, row_number() OVER (PARTITION BY podcast_name ORDER BY episode_count DESC, topic_name)::INT AS rank
           FROM topic_counts QUALIFY rank <= 5""",
        "topic_counts",
    ),
    "speaker_frequency": _sql("SELECT * FROM speaker_counts", "speaker_counts"),
    "top_speakers": _sql(
        """SELECT *, row_number() OVER (PARTITION BY podcast_name ORDER BY episode_count DESC, speaker_name)::INT AS rank
           FROM speaker_counts QUALIFY rank <= 5""",
        "speaker_counts",
    ),
    "podcast_stats": _sql(
        """SELECT podcast_name, count(DISTINCT episode_id) AS total_episodes,
             count(DISTINCT CASE WHEN transcribed THEN episode_id END) AS transcribed_episodes,
             count(DISTINCT CASE WHEN NOT transcribed THEN episode_id END) AS untranscribed_episodes,
             round(avg(topic_count), 6) AS avg_topics_per_episode,
             round(avg(speaker_count), 6) AS avg_speakers_per_episode
           FROM facts GROUP BY 1""",
        "facts",
    ),
    "word_counts": _sql("SELECT * FROM words", "words"),
    "transcript_length_series": _sql(
        """SELECT e.episode_id, episode_title, published_at, word_count
           FROM episode e JOIN words w ON w.episode_id = e.episode_id::VARCHAR""",
        "episode", "words",
    ),
    "word_count_summary": _sql(
        """SELECT podcast_id, count(word_count) AS transcripts, min(word_count) AS min_words,
             max(word_count) AS max_words, round_even(avg(word_count), 0)::BIGINT AS avg_words
           FROM words GROUP BY 1""",
        "words",
    ),
}

# The same result however the files are cut into micro-batches.
ORACLE["ingest_stream_by_files"] = ORACLE["ingest_stream"]

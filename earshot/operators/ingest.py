"""From parsed feeds to podcast and episode tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.dates import feed_date, iso_date, mail_date
from earshot.functions.grouping import first_per_group, mark_existing, top_n
from earshot.functions.keys import hash_id, require_distinct_ids
from earshot.functions.once import compute_once, let
from earshot.functions.text import is_missing, strip
from earshot.schemas import FEED_ENTRY, TABLES
from earshot.sources.feeds import parse_feed_entries

FEED_SUFFIXES = (".rss", ".xml")


def _has_feed_suffix(url: Column) -> Column:
    first, second = FEED_SUFFIXES
    return url.endswith(first) | url.endswith(second)


def _ordered_reasons(*rules: tuple[Column, str]) -> Column:
    """The first rule that is broken, NULL when none is."""
    reason = F.lit(None).cast("string")
    for broken, label in reversed(rules):
        reason = F.when(broken, label).otherwise(reason)
    return reason


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    accepted = df.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, df.filter(F.col("reject_reason").isNotNull())


def gate_feed_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``reject_reason``: feed addresses must end in .rss or .xml, case-sensitively."""
    address = F.col(url)
    return df.withColumn(
        "reject_reason",
        _ordered_reasons((is_missing(address), "empty url"), (~_has_feed_suffix(address), "not a feed url")),
    )


def canonical_link() -> Column:
    """Feed address: announced move, else self link, else the main link with a feed suffix."""
    is_self = lambda l: (l["rel"] == "self") & (l["type"] == "application/rss+xml")
    own = F.filter("links", lambda l: F.coalesce(is_self(l), F.lit(False)))
    main = F.col("link")
    suffixed = F.when(is_missing(main) | _has_feed_suffix(main), main).otherwise(
        F.concat(main, F.lit(FEED_SUFFIXES[0]))
    )
    moved = F.col("new_feed_url")
    # A self link without address still wins and leaves the feed without one.
    return (
        F.when(~is_missing(moved), moved).when(F.size(own) > 0, F.get(own, F.lit(0))["href"]).otherwise(suffixed)
    )


def validate_feeds(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feed rows to accepted podcasts (four fields) and rejected rows with a reason."""
    checked = compute_once(
        feeds,
        {
            "podcast_name": strip(F.col("title")),
            "publish_date": feed_date(F.col("published")),
            "language_name": F.lower(strip(F.col("language"))),
            "podcast_url": canonical_link(),
        },
    ).withColumn(
        "reject_reason",
        _ordered_reasons(
            (is_missing(F.col("podcast_name")), "title"),
            (F.col("publish_date").isNull(), "published"),
            (is_missing(F.col("language_name")), "language"),
            (F.col("podcast_url").isNull(), "link"),
        ),
    )
    accepted, rejected = _split(checked)
    fields = ["podcast_name", "publish_date", "language_name", "podcast_url"]
    # Columns that are not feed fields (a row number, a landing time) travel along.
    extra = [c for c in feeds.columns if c not in {"title", "published", "language", "link", "new_feed_url", "links"}]
    return accepted.select(*extra, *fields), rejected.select(*feeds.columns, "reject_reason")


def upsert_languages(accepted: DataFrame, languages: DataFrame) -> DataFrame:
    """Language table with every accepted language in it, duplicates' languages included."""
    names = accepted.select("language_name").distinct()
    new = names.join(languages, "language_name", "left_anti").select(
        hash_id(F.col("language_name")).alias("language_id"), "language_name"
    )
    return languages.select("language_id", "language_name").unionByName(new)


def upsert_podcasts(
    accepted: DataFrame,
    podcasts: DataFrame,
    languages: DataFrame,
    order: str,
    uploaded_at: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Insert podcasts that are not known by url yet.

    Gives the new podcast table, the new language table and one status row
    (``added`` or ``duplicate``) per accepted row; ``order`` identifies the row
    and decides which of several equal urls is added.
    """
    all_languages = upsert_languages(accepted, languages)
    fresh = mark_existing(accepted, podcasts, ["podcast_url"], "is_known")
    winners = first_per_group(
        fresh.filter(~F.col("is_known")),
        ["podcast_url"],
        [order],
        ["podcast_name", "publish_date", "language_name"],
    )
    # A new language's id follows from its name.
    known = languages.select("language_id", "language_name")
    added = winners.join(known, "language_name", "left").select(
        hash_id(F.col("podcast_url")).alias("podcast_id"),
        "podcast_name",
        "publish_date",
        F.coalesce("language_id", hash_id(F.col("language_name"))).alias("language_id"),
        (F.lit(None) if uploaded_at is None else uploaded_at).cast("timestamp_ntz").alias("uploaded_at"),
        "podcast_url",
    )
    marks = winners.select("podcast_url", order).withColumn("status", F.lit("added"))
    # Joined on url and row, not on url alone: copies of one url spread out.
    status = (
        accepted.select(order, "podcast_url")
        .join(marks, ["podcast_url", order], "left")
        .withColumn("status", F.coalesce("status", F.lit("duplicate")))
    )
    table = podcasts.select(*TABLES["podcast"].fieldNames()).unionByName(added)
    return table, all_languages, status


def landed_entries(documents: DataFrame, podcasts: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Entries of the landed documents (``url, body, fetched_at``) of known podcasts; ``extra`` columns travel along."""
    named = podcasts.select("podcast_id", "podcast_name", "podcast_url")
    parsed = parse_feed_entries(documents).join(named, F.col("url") == F.col("podcast_url"))
    derived = {"href": F.lit(None).cast("string"), "published_parsed": iso_date(F.col("published"))}
    return parsed.withColumns(derived).select(*FEED_ENTRY.fieldNames(), *extra)


def merge_versions(entries: DataFrame, document: str) -> DataFrame:
    """Entries of all documents of a podcast, those that several documents have once.

    Entries are the same when their audio address is (without one, when they say
    the same); a document that repeats an entry keeps its repeats. Of the same
    entries a valid one stays, of these the one with the latest date, so that a
    version that is refused or before the cutoff hides no other.
    """
    said = F.when(F.col("audio_url").isNull(), F.struct("title", "link", "published", "links"))
    same = ["podcast_id", "audio_url", "_said", "_nth"]
    checked = checked_episodes(entries).withColumn("_said", said)
    in_document = Window.partitionBy("podcast_id", document, "audio_url", "_said").orderBy("feed_pos")
    counted = checked.withColumns(
        {
            "_nth": F.row_number().over(in_document),
            "_refused": F.col("reject_reason").isNotNull(),
            "_age": -F.unix_micros(F.col("published_at").cast("timestamp")),
        }
    )
    columns = [c for c in entries.columns if c != document]
    order = ["_refused", "_age", "feed_pos"]
    carry = [c for c in columns if c not in same]
    return first_per_group(counted, same, order, carry).select(*columns)


def ingest_cutoffs(
    episodes: DataFrame, cutoff: str = "uploaded_at", lateness: str = "0 seconds"
) -> DataFrame:
    """Latest ``cutoff`` timestamp per podcast, moved back by ``lateness``.

    ``published_at`` with some lateness also finds entries that show up in a
    feed after a later one was loaded.
    """
    if cutoff not in ("uploaded_at", "published_at"):
        raise ValueError("cutoff must be uploaded_at or published_at")
    latest = F.max(cutoff)
    moved = latest - F.expr(f"INTERVAL {lateness}") if lateness != "0 seconds" else latest
    return episodes.groupBy("podcast_id").agg(moved.alias("cutoff"))


def entry_date() -> Column:
    """Parsed date of an entry; the parsed form wins over the text."""
    return F.coalesce(F.col("published_parsed"), mail_date(F.col("published")))


def select_new_episodes(entries: DataFrame, cutoffs: DataFrame, first_n: int = 20) -> DataFrame:
    """Entries to load: the first ``first_n`` of a podcast without episodes, else the newer ones.

    Podcasts whose address is no feed url give nothing; with a cutoff, undated
    entries are left out and the comparison is strict; ``published_parsed`` is
    then filled in where the text gave the date.
    """
    gated = entries.filter(F.coalesce(_has_feed_suffix(F.col("podcast_url")), F.lit(False)))
    known = gated.join(cutoffs.select("podcast_id", "cutoff"), "podcast_id", "left")
    dated = compute_once(known.filter(F.col("cutoff").isNotNull()), {"published_parsed": entry_date()})
    newer = dated.filter(F.col("published_parsed") > F.col("cutoff"))
    first = top_n(
        known.filter(F.col("cutoff").isNull()),
        ["podcast_id"],
        # Versions of a feed have entries at the same place.
        [F.col(c) for c in ("feed_pos", "published", "title", "link", "links")],
        first_n, salt_by=["feed_pos"], rank="_position",
    ).drop("_position")
    return newer.unionByName(first).select(*entries.columns)


def audio_url() -> Column:
    """Address of the audio file, NULL when the entry has no usable one.

    The first enclosure, else the first link of any kind; where that is not
    http(s), the page link or href stands in, and must be http(s) itself.
    """
    first_href = lambda links: F.get(links, F.lit(0))["href"]
    enclosures = lambda links: F.filter(links, lambda l: F.coalesce(l["rel"] == "enclosure", F.lit(False)))
    preferred = let(
        F.filter("links", lambda l: ~is_missing(l["href"])),
        lambda links: F.coalesce(first_href(enclosures(links)), first_href(links)),
    )
    page = F.when(~is_missing(F.col("link")), F.col("link")).otherwise(F.col("href"))
    is_http = lambda url: url.startswith("http://") | url.startswith("https://")
    usable = lambda raw: let(raw, lambda r: let(strip(r), lambda url: F.when(is_http(url), url)))
    return F.coalesce(usable(preferred), usable(page))


def checked_episodes(entries: DataFrame) -> DataFrame:
    """Entries with the episode's fields and ``reject_reason``, the first broken rule."""
    return compute_once(
        entries,
        {"episode_title": strip(F.col("title")), "audio_url": audio_url(), "published_at": entry_date()},
    ).withColumn(
        "reject_reason",
        _ordered_reasons(
            (F.col("podcast_id").isNull(), "podcast_id"),
            (is_missing(F.col("podcast_name")), "podcast_name"),
            (is_missing(F.col("episode_title")), "title"),
            (F.col("audio_url").isNull(), "audio_url"),
            (F.col("published_at").isNull(), "published"),
        ),
    )


def validate_episodes(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries to accepted episodes and rejected entries with the first broken rule.

    Entries of podcasts without id or name are rejected as a whole.
    """
    accepted, rejected = _split(checked_episodes(entries))
    landed = ["fetched_at"] if "fetched_at" in entries.columns else []
    fields = ["podcast_id", "podcast_name", "feed_pos", "episode_title", "audio_url", "published_at", *landed]
    return (
        accepted.select(*fields).withColumn("transcribed", F.lit(False)),
        rejected.select(*entries.columns, "reject_reason"),
    )


def podcasts_with_episodes(accepted: DataFrame, entries: DataFrame) -> DataFrame:
    """Per podcast the entries seen and accepted; podcasts without a valid one drop out."""
    seen = entries.groupBy("podcast_id").agg(F.count("*").alias("entries"))
    valid = accepted.groupBy("podcast_id", "podcast_name").agg(F.count("*").alias("valid_episodes"))
    return valid.join(seen, "podcast_id").select("podcast_id", "podcast_name", "entries", "valid_episodes")


def load_episodes(
    accepted: DataFrame, episodes: DataFrame, podcasts: DataFrame, uploaded_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Insert-if-absent on ``audio_url``, which is unique over all podcasts.

    Rows are ranked by podcast, landing time and feed position; the first of
    several equal urls wins. Gives the episode rows to append and one outcome row
    (``inserted`` or ``skipped``) per accepted row; a row that is given twice
    counts once, so there are as many ``inserted`` outcomes as rows to append.
    """
    landed = ["fetched_at"] if "fetched_at" in accepted.columns else []
    row = ["podcast_id", *landed, "feed_pos"]
    accepted = accepted.dropDuplicates([*row, "audio_url"])
    usable = accepted.filter(F.col("podcast_id").isNotNull() & ~is_missing(F.col("audio_url")))
    # Constraints look at distinct keys only; the big side keeps its hot keys apart.
    candidates = usable.join(podcasts.select("podcast_id").distinct(), "podcast_id", "left_semi")
    carry = ["episode_title", "published_at", "transcribed"]
    firsts = first_per_group(candidates, ["audio_url"], row, carry)
    new = firsts.join(episodes.select("audio_url"), "audio_url", "left_anti")
    stamp = uploaded_at
    if stamp is None:
        stamp = F.col("fetched_at") if landed else F.lit(None)
    inserted = new.select(
        hash_id(F.col("audio_url")).alias("episode_id"),
        "podcast_id",
        stamp.cast("timestamp_ntz").alias("uploaded_at"),
        "audio_url",
        "transcribed",
        "published_at",
        "episode_title",
    )
    # Matched on the whole row key, so that copies of one url do not pile up.
    key = F.struct(*row, "audio_url").alias("_row")
    marks = new.select(key, F.lit("inserted").alias("outcome"))
    outcomes = (
        accepted.withColumn("_row", key)
        .join(marks, "_row", "left")
        .withColumn("outcome", F.coalesce("outcome", F.lit("skipped")))
        .select("podcast_id", "podcast_name", *landed, "feed_pos", "audio_url", "outcome")
    )
    return inserted, outcomes


def require_new_ids(episodes: DataFrame, inserted: DataFrame) -> None:
    """Fail the load when the id of a new episode stands for two urls."""
    require_distinct_ids(inserted, "episode_id", F.col("audio_url"))
    new = inserted.select("episode_id", F.col("audio_url").alias("_url"))
    clash = episodes.join(new, "episode_id").filter(F.col("audio_url") != F.col("_url")).head(1)
    if clash:
        raise ValueError(f"episode_id {clash[0]['episode_id']} of a new episode is taken")


def append_episodes(episodes: DataFrame, inserted: DataFrame) -> DataFrame:
    """Episode table with the new rows, after checking that their ids are sound."""
    require_new_ids(episodes, inserted)
    columns = TABLES["episode"].fieldNames()
    return episodes.select(*columns).unionByName(inserted.select(*columns))


def load_stats(outcomes: DataFrame) -> DataFrame:
    """Totals per podcast and, in the row with NULL podcast, over all of them."""
    per_podcast = outcomes.groupBy("podcast_id", "podcast_name").agg(
        F.count("*").alias("total_episodes"),
        F.count_if(F.col("outcome") == "inserted").alias("inserted_episodes"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_episodes"),
    )
    # The total is taken over the per-podcast rows, so the outcomes are read once.
    key = [F.col("podcast_id"), F.col("podcast_name")]
    counts = ["total_episodes", "inserted_episodes", "skipped_episodes"]
    return per_podcast.groupingSets([key, []], *key).agg(
        F.count("*").alias("total_podcasts"), *[F.sum(c).alias(c) for c in counts]
    )


def cascade_delete(
    tables: dict[str, DataFrame],
    podcast_keys: DataFrame | None = None,
    language_keys: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Tables after deleting podcasts (with everything below them) and languages.

    A deleted language leaves its podcasts with a NULL reference.
    """
    out = dict(tables)
    if podcast_keys is not None:
        gone = podcast_keys.select("podcast_id").distinct()
        gone_episodes = tables["episode"].join(gone, "podcast_id", "left_semi").select("episode_id")
        out["podcast"] = tables["podcast"].join(gone, "podcast_id", "left_anti")
        out["episode"] = tables["episode"].join(gone, "podcast_id", "left_anti")
        for name in ("episode_topics", "episode_speakers", "episode_embedding"):
            if name in tables:
                out[name] = tables[name].join(gone_episodes, "episode_id", "left_anti")
    if language_keys is not None:
        lost = language_keys.select("language_id").distinct()
        out["language"] = tables["language"].join(lost, "language_id", "left_anti")
        marked = mark_existing(out["podcast"], lost, ["language_id"], "_lost")
        out["podcast"] = marked.withColumn(
            "language_id", F.when(~F.col("_lost"), F.col("language_id"))
        )
    return {name: df.select(*tables[name].columns) for name, df in out.items()}

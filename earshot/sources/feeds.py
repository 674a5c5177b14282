"""Landed feed documents (RSS and Atom) as feed rows and entry rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = T.StringType()


def _record(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_ATTRS = _record(("_rel", _TEXT), ("_type", _TEXT), ("_href", _TEXT))
_ENCLOSURE = _record(("_url", _TEXT), ("_type", _TEXT))
_GUID = _record(("_VALUE", _TEXT), ("_isPermaLink", _TEXT))
_ITEM = _record(
    ("title", _TEXT),
    ("link", _TEXT),
    ("guid", _GUID),
    ("pubDate", _TEXT),
    ("enclosure", T.ArrayType(_ENCLOSURE)),
    ("atom:link", T.ArrayType(_ATTRS)),
)
_RSS = _record(
    (
        "channel",
        _record(
            ("title", _TEXT),
            ("link", _TEXT),
            ("pubDate", _TEXT),
            ("language", _TEXT),
            ("itunes:new-feed-url", _TEXT),
            ("atom:link", T.ArrayType(_ATTRS)),
            ("item", T.ArrayType(_ITEM)),
        ),
    )
)


_ENTRY = _record(
    ("title", _TEXT), ("link", T.ArrayType(_ATTRS)), ("published", _TEXT), ("updated", _TEXT)
)
_ATOM = _record(
    ("title", _TEXT),
    ("link", T.ArrayType(_ATTRS)),
    ("published", _TEXT),
    ("updated", _TEXT),
    ("_xml:lang", _TEXT),
    ("entry", T.ArrayType(_ENTRY)),
)


def _atom_links(links: Column) -> Column:
    return F.transform(
        F.coalesce(links, F.array().cast(T.ArrayType(_ATTRS))),
        lambda a: F.struct(
            F.coalesce(a["_rel"], F.lit("alternate")).alias("rel"),
            a["_type"].alias("type"),
            a["_href"].alias("href"),
        ),
    )


def _page_link(link: Column) -> Column:
    one = F.struct(
        F.lit("alternate").alias("rel"), F.lit("text/html").alias("type"), link.alias("href")
    )
    none = F.array().cast("array<struct<rel:string,type:string,href:string>>")
    return F.when(link.isNotNull(), F.array(one)).otherwise(none)


def _enclosures(enclosures: Column) -> Column:
    return F.transform(
        F.coalesce(enclosures, F.array().cast(T.ArrayType(_ENCLOSURE))),
        lambda e: F.struct(
            F.lit("enclosure").alias("rel"), e["_type"].alias("type"), e["_url"].alias("href")
        ),
    )


def _alternate(links: Column) -> Column:
    """Address of the first page link of an Atom element."""
    pages = F.filter(links, lambda a: F.coalesce(a["_rel"], F.lit("alternate")) == "alternate")
    return F.get(pages, F.lit(0))["_href"]


def _rss_item(item: Column) -> Column:
    """An item without link is linked by its guid, unless that says it is no link."""
    is_link = F.coalesce(F.lower(item["guid"]["_isPermaLink"]) != "false", F.lit(True))
    links = F.concat(_page_link(item["link"]), _atom_links(item["atom:link"]), _enclosures(item["enclosure"]))
    return F.struct(
        item["title"].alias("title"),
        F.coalesce(item["link"], F.when(is_link, item["guid"]["_VALUE"])).alias("link"),
        item["pubDate"].alias("published"),
        links.alias("links"),
    )


def _atom_entry(entry: Column) -> Column:
    return F.struct(
        entry["title"].alias("title"),
        _alternate(entry["link"]).alias("link"),
        F.coalesce(entry["published"], entry["updated"]).alias("published"),
        _atom_links(entry["link"]).alias("links"),
    )


def _parsed(raw: DataFrame) -> DataFrame:
    """Documents with the kind of feed they are parsed as; the other one is NULL."""
    body = F.col("body")
    is_atom = body.rlike(r"<feed[\s>]") & ~body.rlike(r"<rss[\s>]")
    permissive = {"mode": "PERMISSIVE"}
    rss = F.when(~is_atom, F.from_xml("body", _RSS, {"rowTag": "rss", **permissive}))
    atom = F.when(is_atom, F.from_xml("body", _ATOM, {"rowTag": "feed", **permissive}))
    kept = [c for c in raw.columns if c != "body"]
    return raw.select(*kept, rss["channel"].alias("channel"), atom.alias("atom"))


def parse_feed_headers(raw: DataFrame) -> DataFrame:
    """One row per document: title, date, language and the feed-level links."""
    channel, atom = F.col("channel"), F.col("atom")
    links = F.concat(_atom_links(channel["atom:link"]), _page_link(channel["link"]))
    return _parsed(raw).select(
        *[c for c in raw.columns if c != "body"],
        F.coalesce(channel["title"], atom["title"]).alias("title"),
        F.coalesce(channel["pubDate"], atom["published"], atom["updated"]).alias("published"),
        F.coalesce(channel["language"], atom["_xml:lang"]).alias("language"),
        F.coalesce(channel["link"], _alternate(atom["link"])).alias("link"),
        channel["itunes:new-feed-url"].alias("new_feed_url"),
        F.when(atom.isNotNull(), _atom_links(atom["link"])).otherwise(links).alias("links"),
    )


def unreadable_feeds(raw: DataFrame) -> DataFrame:
    """Documents that are no well-formed feed; they give no header and no entry."""
    readable = F.col("channel").isNotNull() | F.col("atom.title").isNotNull() | F.col("atom.entry").isNotNull()
    return _parsed(raw).filter(~readable).select("url")


def parse_feed_entries(raw: DataFrame) -> DataFrame:
    """One row per item or entry in document order (``feed_pos`` from 0)."""
    kept = [c for c in raw.columns if c != "body"]
    items = F.coalesce(F.transform("channel.item", _rss_item), F.transform("atom.entry", _atom_entry))
    found = _parsed(raw).select(*kept, F.posexplode(items).alias("feed_pos", "item"))
    return found.select(
        *kept,
        F.col("feed_pos").cast("bigint").alias("feed_pos"),
        "item.title",
        "item.link",
        "item.published",
        "item.links",
    )


def parse_feeds(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed documents (``url``, ``body``) to feed rows and entry rows.

    Further columns of a document, such as its landing time, go to all its rows.
    """
    return parse_feed_headers(raw), parse_feed_entries(raw)

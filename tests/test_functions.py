import os
import random
from datetime import datetime
from email.utils import parsedate_to_datetime
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from earshot import session
from earshot.functions import dates, keys, text, vectors
from earshot.functions.grouping import first_per_group, mark_existing, ordered_concat, running_total, top_n


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_strip_equals_python(spark):
    values = ["  a b ", " x　", "\x1c\x1fy\x85", "z", "", " \t\n", "a​", " in  ner "]
    assert column(spark, values, text.strip) == [v.strip() for v in values]


def test_title_words_breaks_at_every_non_alphanumeric(spark):
    values = ["AI-powered", "ai-Powered", "o'BRIEN", "3d printing", "éa_b"]
    assert column(spark, values, text.title_words) == ["Ai-Powered", "Ai-Powered", "O'Brien", "3d Printing", "Éa_B"]


def test_word_count_is_blanks_plus_one(spark):
    assert column(spark, ["", "a", "a b", "a  b", " ", None], text.count_words_by_space) == [1, 1, 2, 3, 2, None]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("and so we left. Rain began at noon.", "Rain began at noon."),
        ("Rain began at noon. We stayed.", "Rain began at noon. We stayed."),
        ("no stop anywhere in these words",) * 2,
        ("", ""),
        ("one. two. Three comes last.", "Three comes last."),
        ("what a day! It was over.", "It was over."),
        ("who knows? Nobody does.", "Nobody does."),
        ("the end.\t  Then a gap.", "Then a gap."),
        ("just this. \n \t", "just this. \n \t"),
        ("q" * 101 + ". Beyond the window.", "q" * 101 + ". Beyond the window."),
        ("été fini. Vint l'hiver.\nPuis rien", "Puis rien"),
    ],
)
def test_sentence_start(spark, given, expected):
    assert column(spark, [given], text.sentence_start) == [expected]


MAIL_DATES = [
    "Fri, 07 Mar 2003 04:15:09 +0000",
    "Fri, 07 Mar 2003 04:15:09 -0845",
    "7 Mar 2003 04:15:09 +1100",
    "Fri, 07 Mar 2003 04:15:09 GMT",
    "Fri, 07 Mar 2003 04:15 MST",
    "Fri, 07 Mar 03 04:15:08 CDT",
    "Fri, 07 March 1987 04:15:09",
    "Fri, 07 Mar 2003 04:15:09+0900",
    "Fri, 07 Mar 2003 04:15:09 QQQ",
    "Abc, 07-Mar-2003 04:15:09 +0000",
    "Fri, 07 Mar 2003 04:15:09 -0000",
    "\tFri, 07 Mar 2003 04:15:09 +0000\n",
    "Fri, 31 Apr 2003 04:15:09 +0000",
    "Fri, 07 Mar 2003 25:15:09 +0000",
    "Fri, 07 Mar 2003 04:15:61 +0000",
    "soon",
    "2003-03-07",
    "Fri, 07 Abc 2003 04:15:09 +0000",
    "",
]


def python_mail_date(value):
    try:
        parsed = parsedate_to_datetime(value.strip())
    except (ValueError, TypeError):
        return None
    if parsed.tzinfo is not None:
        parsed = (parsed - parsed.utcoffset()).replace(tzinfo=None)
    return parsed


def test_mail_dates_equal_the_mail_parser(spark):
    assert column(spark, MAIL_DATES, dates.mail_date) == [python_mail_date(v) for v in MAIL_DATES]


def test_iso_dates(spark):
    given = {
        "2003-03-07": datetime(2003, 3, 7), "2003-03-07T04:15:09Z": datetime(2003, 3, 7, 4, 15, 9),
        "2003-03-07T04:15:09.75+02:00": datetime(2003, 3, 7, 2, 15, 9), "2003-03-07 04:15": datetime(2003, 3, 7, 4, 15),
        " 2003-03-07T04:15:09-0130 ": datetime(2003, 3, 7, 5, 45, 9), "2003-13-07": None, "2003-02-30T00:00:00Z": None,
        "2003": None, "Fri, 07 Mar 2003 04:15:09 +0000": None, "": None, "2003-03-07T04:15Z": datetime(2003, 3, 7, 4, 15),
        "2003-03-07T04:15+02:00": datetime(2003, 3, 7, 2, 15), "2003-03-07 04:15-0130": datetime(2003, 3, 7, 5, 45),
    }
    assert column(spark, list(given), dates.iso_date) == list(given.values())


def random_dates(seed, count):
    """Date texts put together from good and bad parts."""
    pick = random.Random(seed).choice
    join = lambda *parts: " ".join(p for p in parts if p)
    return [
        join(
            pick(["Mon,", "Tue,", "", "Wed", "Foo,", "sun,"]), pick(["1", "05", "31", "30", "0", "32"]),
            pick(["Jan", "feb", "MAR", "Apr", "June", "September", "Xyz", "12"]),
            pick(["2024", "1999", "24", "70", "68", "02024"]),
            pick(["12:30:15", "00:00", "23:59:59", "24:00:00", "7:05:09", "12:61:00", "12"]),
            pick(["+0000", "-0700", "+0530", "GMT", "UT", "Z", "EST", "pdt", "", "+05:30", "-0000", "foo"]),
        )
        for _ in range(count)
    ]


def test_random_dates(spark):
    given = random_dates(3, 2000)
    assert column(spark, given, dates.mail_date) == [python_mail_date(v) for v in given]
    assert column(spark, given, dates.feed_date) == [python_feed_date(v) for v in given]


def test_random_texts_are_stripped_as_in_python(spark):
    source = random.Random(4)
    alphabet = "ab.  \t\n\x0b\x1c\x1f\x85\xa0\u2003\u2028\u3000\u200bé"
    given = ["".join(source.choice(alphabet) for _ in range(source.randrange(9))) for _ in range(2000)]
    assert column(spark, given, text.strip) == [v.strip() for v in given]


FEED_DATES = [
    "Thu, 09 Sep 2010 06:07:08 +0000",
    "Wed, 30 Jun 2010 18:45:10 -0930",
    "thu, 9 sep 2010 6:7:8 +04:15",
    "Thu, 09 Sep 2010 06:07:08 Z",
    "2010-09-09",
    "2010-09-09T06:07:08Z",
    "Thu, 31 Sep 2010 06:07:08 +0000",
    "Thu, 09 Abc 2010 06:07:08 +0000",
    "Abc, 09 Sep 2010 06:07:08 +0000",
    "Thu, 09 Sep 2010 06:07:08 GMT",
    "Thu, 09 Sep 2010 06:07:08",
    "Thu, 09 Sep 10 06:07:08 +0000",
    "Thu, 09 Sep 2010 06:07:08 +0000 ",
    "",
]


def python_feed_date(value):
    try:
        parsed = datetime.strptime(value, "%a, %d %b %Y %H:%M:%S %z")
    except ValueError:
        return None
    return (parsed - parsed.utcoffset()).replace(tzinfo=None)


def test_feed_dates_equal_strptime(spark):
    assert column(spark, FEED_DATES, dates.feed_date) == [python_feed_date(v) for v in FEED_DATES]
    assert column(spark, [None], dates.feed_date) == [None]


def test_vectors(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>"
    )
    got = df.select(vectors.cosine_similarity(F.col("a"), F.col("b")), vectors.l2_distance(F.col("a"), F.col("b"))).collect()
    assert got[0][0] == pytest.approx(0.5**0.5) and got[0][1] == pytest.approx(1.0)
    assert got[1][0] is None and got[1][1] == pytest.approx(2**0.5)


def test_running_total_of_a_hot_group(spark):
    """A third of all rows in one group, a NULL group, and values in no order."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None)
        .otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("at"), "id",
    )
    got = running_total(df, ["g"], [F.col("at"), F.col("id")], F.col("id"), "total").toPandas()
    assert len(got) == n
    ordered = got.assign(g=got.g.fillna("none")).sort_values(["g", "at", "id"])
    expected = ordered.groupby("g")["id"].cumsum()
    assert (ordered["total"] == expected).all()


def test_ordered_concat_over_many_blocks(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3 == 0).alias("hot"), "id",
        F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("t"),
    )
    got = {r["hot"]: r["joined"] for r in ordered_concat(df, ["hot"], "id", "t", "\n", "joined", block=100).collect()}
    for hot in (True, False):
        assert got[hot] == "\n".join(str(i) for i in range(5000) if (i % 3 == 0) == hot and i % 7)


def test_ordered_concat_keeps_empty_texts_and_quotes(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, ""), (1, 2, "b")], "k int, p int, t string")
    assert ordered_concat(df, ["k"], "p", "t", "'", "j").first()["j"] == "a''b"


@pytest.mark.parametrize("n", [5, 500])
def test_top_n_of_a_hot_group(spark, n):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100 + 1).alias("g"), "id")
    got = top_n(df, ["g"], [F.col("id").desc()], n, salt_by=["id"]).toPandas()
    pdf = df.toPandas().sort_values("id", ascending=False).groupby("g").head(n)
    assert len(got) == len(pdf) and set(got["id"]) == set(pdf["id"])
    assert got[got.g == 0].sort_values("rank")["id"].tolist() == [8997 - 3 * i for i in range(n)]


def test_first_per_group_and_mark_existing(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert rows(first_per_group(df, ["k"], ["o"], ["v"])) == [("a", 1, "y"), ("b", 5, "z")]
    known = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(mark_existing(df, known, ["k"], "known"), "v", "known") == [("x", True), ("y", True), ("z", False)]


def test_id_collisions_stop_the_load(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id bigint, name string")
    assert keys.require_distinct_ids(df, "id", F.col("name")) is df
    with pytest.raises(ValueError, match="stands for two keys"):
        keys.require_distinct_ids(df.withColumn("id", F.lit(1)), "id", F.col("name"))


def test_scratch_is_removed_behind_a_step(spark, folder):
    kept = session.scratch_path(spark, "kept")
    with session.scratch_removed(spark):
        rows = session.fixed(spark.range(5).toDF("id"))
        inner = rows.inputFiles()
        assert inner and all(os.path.exists(unquote(f.removeprefix("file://"))) for f in inner)
        rows.write.parquet(kept)
    assert not any(os.path.exists(unquote(f.removeprefix("file://"))) for f in inner)
    assert spark.read.parquet(kept).count() == 5
    after = session.fixed(spark.range(2).toDF("id"))
    with pytest.raises(RuntimeError), session.scratch_removed(spark):
        failing = session.fixed(spark.range(3).toDF("id"))
        raise RuntimeError("stopped")
    assert failing.count() == 3 and after.count() == 2

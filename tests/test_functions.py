"""Scalar expressions on literal values, against plain Python where it has the same function."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelake.functions import dates, keys, scoring, text


def anchor():
    return F.lit("2024-03-31 00:30:00").cast("timestamp_ntz")


@pytest.mark.parametrize(
    ("posted", "day"),
    [
        ("Posted today", "2024-03-31"),
        ("Posted yesterday", "2024-03-30"),
        ("Posted 3 days ago", "2024-03-28"),
        ("Posted 30+ days ago", "2024-03-01"),
        ("Posted a day ago", "2024-03-30"),
        ("Posted 2 weeks ago", "2024-03-17"),
        ("Posted 1 month ago", "2024-02-29"),
        ("Posted 1 year ago", "2023-03-31"),
        ("Posted an hour ago", "2024-03-30"),
        ("Posted 20 minutes ago", "2024-03-31"),
        ("Posted 45 minutes ago", "2024-03-30"),
        ("Posted 10 seconds ago", "2024-03-31"),
        ("Posted 2024-02-03", "2024-02-03"),
        ("Posted March 5, 2024", "2024-03-05"),
        ("Posted 5 Mar 2024", "2024-03-05"),
        ("Posted 02/28/2024", "2024-02-28"),
        ("Posted 2024-02-31", "9999-12-30"),
        ("Posted soon", "9999-12-30"),
        ("Posted last week", "2024-03-24"),
        ("Posted 2 hrs ago", "2024-03-30"),
        ("Posted 3 days, 2 hours ago", "2024-03-27"),
        ("Posted about 1 year and 2 months ago", "2023-01-31"),
        ("Posted 05.01.2024", "2024-01-05"),
        ("Posted 2024-01-05T10:00:00", "2024-01-05"),
        ("Posted 5 Jan", "2024-01-05"),
        ("Posted 25 December", "2023-12-25"),
        ("Posted Jan 5th, 2024", "2024-01-05"),
        ("Posted on 5 January 2024", "2024-01-05"),
        ("Posted 0000000003 days ago", "2024-03-28"),
        ("Posted 99999999999 days ago", "9999-12-30"),
        ("Posted 1000000 months ago", "9999-12-30"),
        ("Posted 3 apples ago", "9999-12-30"),
        ("Posted 3d ago", "2024-03-28"),
        ("Posted 2 weeks, 3 days and an hour ago", "2024-03-13"),
        ("Posted 900000 days ago", "9999-12-30"),
        ("Posted 23999 months, 700000 days ago", "9999-12-30"),
        ("Posted 2024/02/03", "2024-02-03"),
        ("Posted 2024/02-03", "9999-12-30"),
        ("Posted 28/02/2024", "2024-02-28"),
        ("Posted 13.13.2024", "9999-12-30"),
        ("Posted 30 February 2024", "9999-12-30"),
        ("Posted May 5", "2023-05-05"),
        ("Posted 5 nonsense 2024", "9999-12-30"),
        ("Posted 5th of January 2024 10:30", "2024-01-05"),
        ("Veröffentlicht vor 3 Tagen", "2024-03-28"),
        ("Veröffentlicht vor einem Monat", "2024-02-29"),
        ("Veröffentlicht vor 1 Jahr und 2 Monaten", "2023-01-31"),
        ("Veröffentlicht gestern", "2024-03-30"),
        ("Veröffentlicht am 5. März 2024", "2024-03-05"),
        ("Posted vor 2 Wochen", "2024-03-17"),
        ("Posted 2 Wochen", "9999-12-30"),
        ("Publié il y a 3 jours", "2024-03-28"),
        ("Publié il y a un an", "2023-03-31"),
        ("Publié il y a plus de 2 semaines et 1 heure", "2024-03-16"),
        ("Publié aujourd'hui", "2024-03-31"),
        ("Publié le 1er février 2024", "2024-02-01"),
        ("Publié le 31 décembre", "2023-12-31"),
        ("Publicado hace 5 días", "2024-03-26"),
        ("Publicada hace un mes", "2024-02-29"),
        ("Publicado hace más de 2 semanas y 3 días", "2024-03-14"),
        ("Publicado ayer", "2024-03-30"),
        ("Publicado el 5 de enero de 2024", "2024-01-05"),
        ("Publicado 5 ago 2023", "2023-08-05"),
        ("", "9999-12-30"),
        (None, "9999-12-30"),
    ],
)
def test_posted_date(value, posted, day):
    assert value(dates.parse_posted_date("x", anchor()), "x string", posted) == dt.date.fromisoformat(day)


def test_minute_and_calendar(spark, rows):
    ts = dt.datetime(2024, 1, 1, 12, 34, 56, 789)
    df = rows("x timestamp_ntz", (ts,))
    assert df.select(dates.truncate_minute("x").alias("m")).first()["m"] == dt.datetime(2024, 1, 1, 12, 34)
    assert df.select(dates.truncate_minute("x").alias("m")).dtypes == [("m", "timestamp_ntz")]


def test_fold_accents(value):
    assert value(text.fold_accents("x"), "x string", "Málaga, Köln, Łódź, Straße, São, Ærø") == (
        "Malaga, Koln, Lodz, Strasse, Sao, AEro"
    )
    assert value(text.fold_accents("x"), "x string", "é") == "e"


def test_entities(value):
    page = "a &lt; b &amp;lt; &#233;&#xE9; &quot;&copy;&quot; &#1F600; &#x1F600; &#; &unknown; R&D"
    assert value(text.unescape_entities("x"), "x string", page) == (
        'a < b &lt; éé "©" &#1F600; 😀 &#; &unknown; R&D'
    )
    page = "M&uuml;nchen caf&eacute; &#38;lt;b&#38;gt; &#00000000065; &#x000000041; &#99999999999; &#xD800; &;"
    assert value(text.unescape_entities("x"), "x string", page) == (
        "München café &lt;b&gt; A A &#99999999999; &#xD800; &;"
    )
    assert value(text.unescape_entities("x"), "x string", None) is None


def test_first_nonempty_and_none(value):
    first = text.take_first_nonempty(F.array(F.lit(None), F.lit(""), F.col("x"), F.lit("z")))
    assert value(first, "x string", "y") == "y"
    assert value(text.take_first_nonempty(F.array(F.lit(""), F.col("x"))), "x string", None) is None
    assert value(text.null_to_none("x"), "x string", None) == "None"
    assert value(text.null_to_none("x"), "x string", "") == ""


def test_surrogate_key(value):
    assert value(keys.surrogate_key("x", 5), "x string", "abc") == "90015"
    assert value(keys.surrogate_key("x", 5), "x string", None) is None


TEXTS = st.lists(
    st.text(
        alphabet=st.sampled_from("aé1_ß ., \n\t\xa0 \x1c-'"), min_size=0, max_size=80
    ),
    min_size=1,
    max_size=20,
)


@settings(max_examples=15, deadline=None)
@given(texts=TEXTS)
def test_squeeze_and_chunks_equal_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, x string")
    found = df.select(
        "id",
        text.squeeze_whitespace("x").alias("squeezed"),
        text.chunk_text("x", 7).alias("chunks"),
    ).collect()
    for row in found:
        original = texts[row["id"]]
        assert row["squeezed"] == " ".join(original.split())
        assert row["chunks"] == re.findall(r"(.{1,7})(?=\b)", original)


def test_chunks_of_whole_documents_equal_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    joined = {r["doc_id"]: " ".join(r["text"].split()) for r in docs.collect()}
    squeezed = docs.select(F.col("doc_id").alias("id"), text.squeeze_whitespace("text").alias("x"))
    pieces = text.explode_chunks(squeezed, "id", "x")
    found: dict[int, list[str]] = {}
    for row in pieces.orderBy("id", "pos").collect():
        found.setdefault(row["id"], []).append(row["chunk"])
    assert found == {k: v for k, v in ((k, re.findall(r"(.{1,3000})(?=\b)", t)) for k, t in joined.items()) if v}
    again = {r["id"]: r["text"] for r in text.rejoin_chunks(pieces, "id").collect()}
    assert again == {k: "".join(v) for k, v in found.items()}


@pytest.mark.parametrize(
    ("a", "b", "c", "best"),
    [(0.1, 0.7, 0.2, "b"), (0.4, 0.4, 0.2, "a"), (None, None, 0.0, "c"), (None, None, None, None)],
)
def test_argmax(value, a, b, c, best):
    scores = scoring.score_map({name: F.col(name) for name in "abc"})
    chosen = scoring.argmax_category(scores, ["a", "b", "c"])
    assert value(chosen, "a double, b double, c double", a, b, c) == best


def test_hash_bucket_depends_on_the_key_alone(spark):
    buckets = spark.range(5000).select(scoring.hash_bucket(F.col("id"), 5).alias("b")).groupBy("b").count()
    counts = {r["b"]: r["count"] for r in buckets.collect()}
    assert set(counts) == set(range(5)) and min(counts.values()) > 800

"""Roles, tools and places on literal adverts."""

import pytest
from pyspark.sql import functions as F

from hirelake.operators import enrich, text_ml
from hirelake.sources.iso import ISO_SHORT_NAMES, iso_names


@pytest.mark.parametrize(
    ("title", "role"),
    [
        ("Senior Data Scientist", "Data Scientist"),
        ("Junior data analyst (m/f/d)", "Data Analyst"),
        ("BI Developer", "Data Analyst"),
        ("Machine Learning Engineer", "Machine Learning Engineer"),
        ("ML Ops", "Machine Learning Engineer"),
        ("Data Engineer", "Data Engineer"),
        ("Baker", "Other"),
        ("HTML writer", "Other"),
        ("  ", "None"),
        ("", "None"),
        (None, "None"),
    ],
)
def test_role(value, title, role):
    assert value(enrich.role_from_title("x"), "x string", title) == role
    assert role == "None" or role in enrich.ROLES


@pytest.mark.parametrize(
    ("description", "tools"),
    [
        ("We use Python, SQL and python.", "Python, SQL, python"),
        ("Power BI on SQL Server; C++ and C#.", "Power BI, SQL Server, C++, C#"),
        ("MySQL is not SQLite, Pythonic is not it", "MySQL"),
        ("scikit-learn/PyTorch", "scikit-learn, PyTorch"),
        ("éSQL SQLé _SQL", ""),
        ("no tools", ""),
        ("", ""),
        (None, None),
    ],
)
def test_tools(value, description, tools):
    assert value(enrich.list_of_tools("x"), "x string", description) == tools


def test_spans_keep_the_earlier_then_the_longer(rows):
    docs = rows("id long, t string", (1, "a b c d"), (2, "b c b"), (3, "x"), (4, None))
    lexicon = rows("term string", ("a b",), ("b c d",), ("b",), ("c",), ("B",))
    found = enrich.tool_spans(docs, "id", "t", lexicon).collect()
    assert sorted((r["id"], r["start"], r["n_words"], r["term"]) for r in found) == [
        (1, 0, 2, "a b"),
        (1, 2, 1, "c"),
        (2, 0, 1, "b"),
        (2, 1, 1, "c"),
        (2, 2, 1, "b"),
    ]


PLACES = [
    ("Germany", "Berlin"),
    ("Brazil", "São Paulo"),
    ("France", "Paris"),
    ("United States", "Paris"),
    ("United States", "New York"),
    ("United Kingdom", "York"),
]


def geo(spark, rows, texts, gazetteer=True):
    adverts = rows("id long, location string", *enumerate(texts))
    table = rows("country string, city string", *PLACES) if gazetteer else None
    found = enrich.with_geo(adverts, table).collect()
    assert len(found) == len(texts)
    return {r["location"]: None if r["geo"] is None else tuple(r["geo"]) for r in found}


def test_places(spark, rows):
    assert geo(
        spark,
        rows,
        [
            "Berlin, Germany",
            "Sao Paulo, BR",
            "Paris, France",
            "Paris, Texas, United States",
            "New York, NY",
            "Lisbon, PT",
            "San Jose, CA",
            "somewhere de",
            "DEUTSCHLAND",
            "AT or DE",
            "",
            None,
        ],
    ) == {
        "Berlin, Germany": ("Germany", "Berlin"),
        "Sao Paulo, BR": ("Brazil", "São Paulo"),
        "Paris, France": ("France", "Paris"),
        "Paris, Texas, United States": ("United States", "Paris"),
        "New York, NY": ("United States", "New York"),
        "Lisbon, PT": ("Portugal", "Not Defined"),
        "San Jose, CA": ("Canada", "Not Defined"),
        "somewhere de": ("Not Defined", "Not Defined"),
        "DEUTSCHLAND": ("Not Defined", "Not Defined"),
        "AT or DE": ("Austria", "Not Defined"),
        "": ("Not Defined", "Not Defined"),
        None: None,
    }


def test_places_without_gazetteer(spark, rows):
    assert geo(spark, rows, ["Berlin, DE", "Berlin"], gazetteer=False) == {
        "Berlin, DE": ("Germany", "Not Defined"),
        "Berlin": ("Not Defined", "Not Defined"),
    }


def test_iso_names(spark):
    names = iso_names(spark)
    assert len(names) >= 249 and names["DE"] == "Germany" and names["VN"] == "Viet Nam"
    assert set(ISO_SHORT_NAMES) <= set(names)


def test_long_terms_and_places_are_found(spark, rows):
    docs = rows("id long, t string", (1, "we run Amazon Web Services Cloud Formation daily"))
    lexicon = rows("term string", ("amazon web services cloud formation",), ("cloud",))
    assert [r["term"] for r in enrich.tool_spans(docs, "id", "t", lexicon).collect()] == ["amazon web services cloud formation"]
    adverts = rows("id long, location string", (1, "Santa Cruz de Tenerife, Spain"), (2, "London"), (3, None))
    table = rows(
        "country string, city string, rank int",
        ("Bolivia", "Santa Cruz", 1), ("Spain", "Santa Cruz de Tenerife", 9), ("Canada", "London", 2), ("United Kingdom", "London", 1),
    )
    found = {r["id"]: r["geo"] and tuple(r["geo"]) for r in enrich.with_geo(adverts, table).collect()}
    assert found == {1: ("Spain", "Santa Cruz de Tenerife"), 2: ("United Kingdom", "London"), 3: None}


def test_tools_that_are_words_are_looked_for_as_spelled(value):
    tools = enrich.list_of_tools("x")
    assert value(tools, "x string", "We excel at teamwork, go live fast, R&D, spark joy") == ""
    assert value(tools, "x string", "Excel, Go and R; Google Cloud, spark? Spark!") == "Excel, Go, R, Google Cloud, Spark"


def test_tagged_spans_equal_spans_by_words(rows):
    docs = rows("id long, t string", (1, "a, b; c a b"), (2, "x"), (3, None), (4, "b"))
    terms = ["a b", "b", "c"]
    spans = enrich.tool_spans(docs, "id", "t", rows("term string", *[(t,) for t in terms]))
    tagged = enrich.tagged_spans(docs, "id", "t", terms)
    assert tagged.columns == spans.columns
    # Words next to each other make a phrase for the one, a single blank between them for the other.
    assert sorted(map(tuple, tagged.collect())) == [(1, 1, 1, "b"), (1, 2, 1, "c"), (1, 3, 2, "a b"), (4, 0, 1, "b")]
    assert sorted(map(tuple, spans.collect())) == [(1, 0, 2, "a b"), (1, 2, 1, "c"), (1, 3, 2, "a b"), (4, 0, 1, "b")]


def test_tagged_tools_are_whole_words(rows):
    docs = rows("id long, t string", (1, "x a### b c++ a"), (2, "#b a (b, a#b +c"), (3, "a b# c"))
    terms = ["a b", "a", "b", "c", "c++"]
    spans = enrich.tool_spans(docs, "id", "t", rows("term string", *[(t,) for t in terms]))
    tagged = enrich.tagged_spans(docs, "id", "t", terms, blank=f" [^{enrich.WORD_SIGNS}]*")
    expected = [(1, 2, 1, "b"), (1, 3, 1, "c++"), (1, 4, 1, "a"), (2, 1, 2, "a b"), (3, 0, 1, "a"), (3, 2, 1, "c")]
    assert sorted(map(tuple, tagged.collect())) == sorted(map(tuple, spans.collect())) == expected


@pytest.mark.parametrize("looked_up", [4096, 1])
def test_only_words_that_begin_a_tool_meet_the_lexicon(rows, monkeypatch, looked_up):
    monkeypatch.setattr(enrich, "LOOKED_UP", looked_up)
    docs = rows("id long, t string", (1, "x a, b y c### c"), (2, "x y"), (3, None))
    terms = ["a b", "b", "c"]
    spans = enrich.tool_spans(docs, "id", "t", rows("term string", *[(t,) for t in terms]))
    tagged = enrich.tagged_spans(docs, "id", "t", terms, blank=f"[^{enrich.WORD_SIGNS}]+")
    assert sorted(map(tuple, spans.collect())) == sorted(map(tuple, tagged.collect())) == [(1, 1, 2, "a b"), (1, 5, 1, "c")]
    # The rows of a text's words are never sent to all tasks: the side that is, is the lexicon.
    sent = spans._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1].splitlines()[0]
    assert ("rightHint=(strategy=broadcast)" in sent) == (looked_up == 4096)


def test_a_fitted_classifier_names_the_roles(rows):
    known = rows("title string, role string", ("data engineer", "Data Engineer"), ("etl engineer", "Data Engineer"),
                 ("data analyst", "Data Analyst"), ("bi analyst", "Data Analyst"), ("x", None))
    model = text_ml.fit_naive_bayes(known, "title", "role")
    assert (model.labels, model.weights.count()) == (["Data Analyst", "Data Engineer"], 5)
    raw = rows("id long, title string, company string, location string, employment_type string, job_description string",
               (1, "Senior Engineer", "c", "l", "t", None), (2, "Analyst, BI", "c", "l", "t", None),
               (3, None, "c", "l", "t", None), (4, " ", "c", "l", "t", None))
    found = {r["id"]: r["role"] for r in enrich.keyed_postings(raw, role_model=model).collect()}
    assert found == {1: "Data Engineer", 2: "Data Analyst", 3: "None", 4: "None"}


def test_clean_postings_computes_each_column_once_and_keeps_rows(spark, rows):
    raw = rows(
        "id long, title string, company string, location string, employment_type string, date_posted date, "
        "job_description string, metadata_lastupdated timestamp_ntz, metadata_application_link string, "
        "metadata_source string",
        (1, "Data Engineer", "A", "Berlin, DE", "Full time", None, "Spark and SQL", None, None, "s"),
        (2, None, None, None, None, None, None, None, None, None),
    )
    first, second = enrich.clean_postings(raw).orderBy("id").collect()
    assert (first["role"], first["country"], first["toolset_list"]) == ("Data Engineer", "Germany", "Spark, SQL")
    assert len(first["role_key"]) == 32 and len(first["company_key"]) == 32
    assert second["role"] == "None" and second["role_key"] is not None
    assert [second[c] for c in ("company_key", "location_key", "country", "toolset_list")] == [None] * 4

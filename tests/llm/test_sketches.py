import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hirelake.llm import sketches
from hirelake.llm.queries import QUERIES

from .conftest import ODD


def parts(text):
    return set(Counter(re.findall(r"[^\n]{1,200}", text)).items())


def alike(a, b):
    a, b = parts(a), parts(b)
    return 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0


def edited(docs):
    """(doc_id, text, edited, next) by plain means; the smallest text stands for a number."""
    low = -(10**19)
    places = sorted({low if d is None else d for d, _ in docs}, reverse=True)
    first = {p: min(t or "" for d, t in docs if (low if d is None else d) == p) for p in places}
    for d, text in docs:
        text = text or ""
        at = places.index(low if d is None else d)
        following = first[places[(at + 1) % len(places)]]
        third = len(text) // 3
        yield d, text, text[: len(text) - third] + following[:third], following


def check(found, docs):
    wanted = sorted(
        (str(d), len(t), hashlib.sha256(e.encode()).hexdigest(), round(alike(t, e), 9), round(alike(t, n), 9))
        for d, t, e, n in edited(docs)
    )
    names = ("n_chars", "edited_sha256", "near_edited", "near_next")
    got = sorted(
        (str(r["doc_id"]), *(round(r[n], 9) if n.startswith("near") else r[n] for n in names)) for r in found
    )
    assert got == wanted


def test_odd_documents(odd):
    found = sketches.compared_fingerprints(odd).collect()
    check(found, [(r[0], r[1]) for r in ODD])
    same = [r["fingerprint"] for r in found if r["doc_id"] in (4, 5)]
    assert len(same) == 3 and len(set(same)) == 1
    empty = [r["fingerprint"] for r in found if r["doc_id"] in (1, 2)]
    assert empty == ["", ""]


def test_query_equals_brute_force(spark, given):
    folder = "/root/testdata/sf0.001"
    found = QUERIES["op7_lookup_sketch"](spark, folder).collect()
    check(found, [(r["doc_id"], r["text"]) for r in given("documents").collect()])


def test_empty_clashing_and_alone(none, clashing, odd):
    assert sketches.compared_fingerprints(none).collect() == []
    assert sketches.compared_fingerprints(clashing).count() == len(ODD)
    one = sketches.compared_fingerprints(odd.where("doc_id = 7")).first()
    assert one["near_next"] == 1.0


def element_digests(spark, lists):
    """By plain counting: {name: the digests of (paragraph, uses)} of named lists."""
    rows = [(name, p, uses) for name, digests in lists.items() for p, uses in Counter(digests).items()]
    table = spark.createDataFrame(rows, "name string, p long, uses long")
    found = table.select("name", F.xxhash64("p", "uses").alias("digest")).collect()
    return {name: {r["digest"] for r in found if r["name"] == name} for name in lists}


VERSIONS = "row long, pair int, first array<long>, second array<long>"


@pytest.mark.parametrize("n", [0, 1, 5, 40, 3000])
def test_the_differing_digests_are_recovered(spark, n):
    """Lists of which n digests differ on either side; hundreds are shared."""
    shared = list(range(500))
    first, second = shared + [10_000 + k for k in range(n)], shared + [90_000 + k for k in range(n)]
    versions = spark.createDataFrame([(1, 0, first, second), (2, 0, [], [])], VERSIONS)
    digests = element_digests(spark, {"first": first, "second": second})
    found = sketches.differing_digests(versions).collect()
    assert all((r["row"], r["pair"]) == (1, 0) for r in found) and len(found) == 2 * n
    assert {r["digest"] for r in found if r["side"] == 1} == digests["first"] - digests["second"]
    assert {r["digest"] for r in found if r["side"] == -1} == digests["second"] - digests["first"]
    assert {r["row"]: len(r["revealed"]) for r in sketches.differences(versions).collect()} == {1: 2 * n, 2: 0}


def test_repeated_paragraphs_count(spark):
    first, second = [7, 7, 7, 8], [7, 8, 8]
    found = sketches.differing_digests(spark.createDataFrame([(1, 0, first, second)], VERSIONS)).collect()
    digests = element_digests(spark, {"first": first, "second": second})
    assert {(r["digest"], r["side"]) for r in found} == {(d, 1) for d in digests["first"]} | {(d, -1) for d in digests["second"]}


def test_next_places_form_a_circle(spark):
    places = spark.range(0, 500, 3).select(F.col("id").cast("decimal(20,0)").alias("place"))
    found = {int(r["place"]): int(r["next_place"]) for r in sketches.next_places(places).collect()}
    assert found == {k: (k - 3 if k else 498) for k in range(0, 500, 3)}


def test_no_python_on_the_way(odd):
    plan = sketches.compared_fingerprints(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("MapInArrow|MapInPandas|EvalPython|PythonUDF|InPandas", plan)

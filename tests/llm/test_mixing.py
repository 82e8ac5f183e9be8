from collections import defaultdict

from hirelake.llm import mixing
from hirelake.llm.common import word_count

from .conftest import DOCUMENTS, FOLDER


def test_word_count(value):
    for text, n in ((None, 0), ("", 0), (" ", 0), ("a", 1), (" a  b\t\nc ", 3), ("a\x1cb c", 2)):
        assert value(word_count("x"), "x string", text) == n


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Water is shared out by weight and what overflows is shared again, step by step."""
    left, open_, given = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_ and left > 1e-9:
        total = sum(weights[i % 3] for i in open_)
        step = {i: left * weights[i % 3] / total for i in open_}
        left = 0.0
        for i, more in step.items():
            room = most * sizes[i] - given[i]
            given[i] += min(more, room)
            left += max(0.0, more - room)
            if more >= room:
                open_.discard(i)
    return given


def test_targets_and_exact_budgets(spark, odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is None, s))
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    for source, size, target in zip(order, sizes, targets(sizes)):
        taken = sum(r["taken"] for r in by[source])
        assert {r["source_size"] for r in by[source]} == {size}
        assert all(abs(r["target"] - target) < 1e-6 for r in by[source])
        assert abs(taken - target) <= len(by[source])
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in by[source])
        assert all(r["taken"] == r["epochs"] * r["size"] + r["part_words"] for r in by[source])


def test_same_result_on_other_partitions(odd):
    def found(docs):
        return sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in mixing.mix(docs).collect())

    assert found(odd) == found(odd.repartition(7))


def test_more_sources_than_weights(rows):
    docs = rows(DOCUMENTS, *[(k, "a b c d e f g h i j", "en", f"s{k % 9}", 1) for k in range(90)])
    found = mixing.mix(docs).collect()
    sizes = [100] * 9
    wanted = targets(sizes)
    for k in range(9):
        of = [r for r in found if r["source"] == f"s{k}"]
        assert abs(of[0]["target"] - wanted[k]) < 1e-6
        assert sum(r["taken"] for r in of) == round(wanted[k])


def test_mixed_documents(odd):
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    plan = mixing.mix(odd).collect()
    words = lambda t: len((t or "").replace("\x1c", "_").replace(" ", "_").split())
    assert sum(words(r["text"]) for r in mixed.collect()) == sum(r["taken"] for r in plan)
    texts = {r["text"] for r in odd.collect() if r["text"]}
    assert all(any(t.startswith(r["text"]) for t in texts) for r in mixed.collect() if r["text"])


def test_empty_and_clashing(none, clashing):
    assert mixing.mix(none).collect() == []
    assert mixing.mixed_documents(none).collect() == []
    assert mixing.mix(clashing).count() == clashing.count()
    assert set(clashing.columns) <= set(mixing.mix(clashing).columns)
    assert mixing.mixed_documents(clashing).columns == clashing.columns


def test_only_empty_texts(rows):
    docs = rows(DOCUMENTS, (1, None, None, "a", 0), (2, "", None, "b", 0))
    assert [(r["size"], r["taken"], r["target"]) for r in mixing.mix(docs).collect()] == [(0, 0, 0.0)] * 2


def test_first_words(value):
    from pyspark.sql import functions as F

    assert value(mixing.first_words(F.col("x"), F.lit(2)), "x string", " a  b c") == " a  b"


def test_query(spark):
    from hirelake.llm.queries import QUERIES

    found = QUERIES["op1_mix_sources"](spark, FOLDER)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken"]

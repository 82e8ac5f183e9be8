import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from hirelake.llm import periodic
from hirelake.llm.queries import QUERIES
from tests.llm.conftest import FOLDER


def brute(words, exponent=4, least=6):
    """All runs as (start, length, period), by start and period."""
    n, shortest = len(words), {}
    for period in range(1, n // exponent + 1):
        start = None
        for i in range(n - period + 1):
            same = i < n - period and words[i] == words[i + period]
            if same and start is None:
                start = i
            if not same and start is not None:
                if i - start + period >= exponent * period:
                    shortest.setdefault((start, i + period), period)
                start = None
    return sorted((s, e - s, p) for (s, e), p in shortest.items() if e - s >= least)


def sequences(draw):
    n = draw.randrange(100)
    seed = [draw.randrange(3) for _ in range(draw.randrange(1, 9))]
    yield [draw.randrange(2) for _ in range(n)]
    yield [0] * n
    repeated = (seed * 100)[:n]
    yield [draw.randrange(3) if draw.random() < 0.02 else w for w in repeated]
    yield [k.bit_count() & 1 for k in range(n)]
    nested = ([0] * draw.randrange(1, 9) + [1]) * draw.randrange(1, 6) + [2]
    yield (nested * 100)[:n]


@pytest.mark.parametrize("exponent", [2, 3, 4])
def test_catchers_equal_brute_force_however_words_arrive(exponent):
    draw = random.Random(exponent)
    for _ in range(12):
        for words in sequences(draw):
            expected = brute(words, exponent, 1)
            for size in (1, 13, 1000) if len(words) < 40 else (17, 1000):
                catchers = periodic.Catchers(len(words) // exponent, exponent)
                for at in range(0, len(words), size):
                    catchers.append(np.array(words[at : at + size]))
                assert [(r.start, r.end - r.start, r.period) for r in catchers.runs()] == expected


def test_collisions_of_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(periodic, "BASE", 1)  # then hashes are sums, and any order of words collides
    draw = random.Random(5)
    for _ in range(5):
        for words in sequences(draw):
            catchers = periodic.Catchers(len(words) // 4, 4)
            catchers.append(np.array(words))
            assert [(r.start, r.end - r.start, r.period) for r in catchers.runs()] == brute(words, 4, 1)


def test_a_long_text_of_one_word():
    catchers = periodic.Catchers(50_000, 4)
    for _ in range(4):
        catchers.append(np.zeros(50_000, np.int64))
    assert catchers.runs() == [(0, 200_000, 1)]


def collapsed(words, runs):
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_odd_rows(odd, clashing, none, spark):
    rows = periodic.with_runs(odd).collect()
    assert len(rows) == odd.count()
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")
        runs = brute(words) if len(words) < 500 else [tuple(r) for r in row["runs"]]
        assert [tuple(r) for r in row["runs"]] == runs
        assert row["collapsed"] == collapsed(words, runs)
    long = next(r for r in rows if r["doc_id"] == 7)
    assert [tuple(r) for r in long["runs"]] == [(0, 30_000, 1), (30_000, 8_000, 4)]
    assert set(periodic.with_runs(clashing).columns) == {*clashing.columns, "runs", "collapsed"}
    assert periodic.with_runs(none).count() == 0
    table = spark.createDataFrame([(1, "a b " * 4, "x", 2)], "id long, text string, runs string, collapsed int")
    assert [tuple(r) for r in periodic.with_runs(table, keep_text=False).first()["runs"]] == [(0, 8, 2)]


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
    )


def test_query_equals_brute_force(spark, given):
    docs = [r for r in given("documents").collect() if len(r["text"] or "") < 6_000]
    rows = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    assert len(rows) == given("documents").count()
    for doc in docs:
        assert rows[doc["doc_id"]] == expected_row(doc["doc_id"], doc["text"])


def test_query_on_odd_tables(spark, odd, tmp_path):
    odd.where("doc_id <> 7 OR doc_id IS NULL").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    found = sorted((tuple(r) for r in rows if r["doc_id"] is not None), key=str)
    texts = [(r["doc_id"], r["text"]) for r in odd.collect() if r["doc_id"] not in (None, 7)]
    assert found == sorted((expected_row(*t) for t in texts), key=str)

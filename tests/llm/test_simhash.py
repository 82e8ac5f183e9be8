from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hirelake.llm import simhash
from hirelake.llm.components import components
from hirelake.llm.golay import near_indices
from hirelake.llm.queries import QUERIES

from .conftest import DOCUMENTS, FOLDER


def plain_simhash(text, width):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(shingles))


def groups(prints, apart):
    """Root of each, by comparing all with all."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (int(prints[i]) ^ int(prints[j])).bit_count() <= apart:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("width", [1, 4, 5])
def test_fingerprints(odd, width):
    for r in simhash.with_fingerprints(odd, width=width).collect():
        assert r["fingerprint"] & (1 << 64) - 1 == plain_simhash(r["text"], width)


def test_golay_words_within_two_bits_share_an_index():
    random = np.random.default_rng(1)
    words = random.integers(0, 1 << 23, 5000)
    others = words.copy()
    for k in range(len(others)):
        for bit in random.choice(23, random.integers(0, 3), replace=False):
            others[k] ^= 1 << bit
    (a, real_a), (b, real_b) = near_indices(words), near_indices(others)
    for k in range(len(words)):
        assert set(a[k][real_a[k]]) & set(b[k][real_b[k]])
    assert set(real_a.sum(axis=1)) == {1, 6}


def near_prints(n, apart, seed):
    random = np.random.default_rng(seed)
    prints = random.integers(0, 1 << 63, n).astype(np.uint64)
    for k in range(n // 2, n):
        prints[k] = prints[random.integers(0, n // 2)]
        for bit in random.choice(64, random.integers(0, apart + 2), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(bit)
    return np.unique(prints)


@pytest.mark.parametrize("apart", [0, 1, 2, 3, 4])
@pytest.mark.parametrize("most", [1 << 15, 3])
def test_links_connect_what_brute_force_connects(spark, apart, most, monkeypatch):
    """With ``most`` = 3 every key goes through midpoints; the components are the same."""
    monkeypatch.setattr(simhash, "MOST_COMPARED", most)
    prints = near_prints(60 if most == 3 else 600, apart, apart)
    table = spark.createDataFrame([(int(p.view(np.int64)),) for p in prints], "print long")
    found = simhash.links(table, apart, most).collect()
    at = {int(p.view(np.int64)): k for k, p in enumerate(prints)}
    pairs = [(at[r["u"]], at[r["v"]]) for r in found]
    assert all((int(prints[a]) ^ int(prints[b])).bit_count() <= apart for a, b in pairs)
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(prints))] == groups(prints, apart)


def test_long_runs_cross_batches(spark):
    """A cluster that shares keys, read in batches of a few rows."""
    prints = near_prints(300, 4, 9)
    cluster = np.unique(np.array([int(prints[0]) ^ (1 << b) ^ (1 << c) for b in range(64) for c in range(b)], np.uint64))
    table = spark.createDataFrame([(int(p.view(np.int64)),) for p in cluster], "print long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for most in (1 << 15, 50):
            edges = simhash.links(table, 4, most)
            assert components(edges).agg(F.countDistinct("root")).first()[0] == 1
            assert components(edges).count() == len(cluster)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_heavy_keys_go_through_midpoints(spark):
    prints = near_prints(400, 4, 3)
    table = spark.createDataFrame([(int(p.view(np.int64)),) for p in prints], "print long")
    usual = components(simhash.links(table)).collect()
    some = simhash.heavy_keys(table, sample=1, least=1, share=10**9)
    assert len(some)
    keyed = simhash._keyed(table, some).where("key IS NULL").count()
    assert keyed > 0 and len(usual) > 0


def test_components_of_paths_stars_and_loops(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(5, k) for k in range(6, 40)]
    odd = [(1, 1), (2, None), (200, 201), (201, 200), (200, 201)]
    edges = spark.createDataFrame(path + star + odd, "u long, v long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {k: 100 for k in range(100, 161)} | {k: 5 for k in range(5, 40)} | {200: 200, 201: 200}
    assert components(edges.where("false")).collect() == []


def test_groups_of_odd_documents(odd):
    found = simhash.near_duplicate_groups(odd).collect()
    prints = [int(r["fingerprint"], 16) for r in found]
    roots = groups(prints, 4)
    for k, r in enumerate(found):
        numbers = [f["doc_id"] for f, root in zip(found, roots) if root == roots[k] and f["doc_id"] is not None]
        assert r["component_id"] == (min(numbers) if numbers else None)
    for root in set(roots):
        assert sum(f["kept"] for f, other in zip(found, roots) if other == root) == 1


def test_one_document_of_each_group_stays(odd):
    found = simhash.near_duplicate_groups(odd).collect()
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    numbers = Counter(r["component_id"] for r in found if r["kept"])
    assert Counter(r["doc_id"] for r in kept.collect()) == numbers
    assert set(numbers) == {r["component_id"] for r in found} and numbers[1] == 1  # texts without words are alike


def test_near_copies_go_and_others_stay(rows):
    """Copies with one changed word of 900 and their original: groups as brute force finds them."""
    words = [f"word{k}" for k in range(900)]
    docs = [(k, " ".join([*words[: 7 * k], f"changed{k}", *words[7 * k + 1 :]]), "en", "a", 1) for k in range(60)]
    docs += [(100 + k, " ".join(f"other{k}x{j}" for j in range(50)), "en", "a", 1) for k in range(30)]
    prints = [plain_simhash(d[1], 4) for d in docs]
    expected = {docs[k][0] for k in groups(prints, 4)}
    kept = {r["doc_id"] for r in simhash.deduplicated(rows(DOCUMENTS, *docs)).collect()}
    assert kept == expected and len([k for k in kept if k < 100]) < 60 and {k for k in kept if k >= 100} == set(range(100, 130))


def test_empty_and_clashing(none, clashing):
    assert simhash.near_duplicate_groups(none).collect() == []
    assert simhash.deduplicated(none).collect() == []
    assert simhash.near_duplicate_groups(clashing).count() == clashing.count()
    assert simhash.deduplicated(clashing).columns == clashing.columns


def test_query_equals_brute_force(spark, given):
    found = QUERIES["op2_simhash_near_dedup"](spark, FOLDER).orderBy("doc_id").collect()
    docs = given("documents").orderBy("doc_id").collect()
    prints = [plain_simhash(d["text"], 4) for d in docs]
    assert [r["fingerprint"] for r in found] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in found] == [docs[k]["doc_id"] for k in groups(prints, 4)]


def test_near_copies_are_linked(rows):
    words = [f"word{k}" for k in range(400)]
    docs = [(k, " ".join(words[:200] + [f"changed{k}"] + words[201:]), "en", "a", 1) for k in range(40)]
    found = simhash.near_duplicate_groups(rows(DOCUMENTS, *docs, (99, "something else entirely here now", "en", "a", 1)))
    roots = groups([int(r["fingerprint"], 16) for r in found.collect()], 4)
    assert len({r["component_id"] for r in found.collect()}) == len(set(roots)) >= 2

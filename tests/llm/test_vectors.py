import numpy as np
import pytest

from hirelake.llm import vectors
from hirelake.llm.queries import QUERIES

from .conftest import FOLDER

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.9):
    """{place: (links, component)} by comparing all with all."""
    units = []
    for _, x in rows:
        x = np.array([np.nan if v is None else v for v in (x or [])], float)
        norm = np.sqrt((x * x).sum()) if len(x) else 0
        units.append(x / norm if np.isfinite(norm) and norm > 0 else None)
    n = len(rows)
    links = [
        [j for j in range(n) if j != i and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least]
        for i in range(n)
    ]
    found, seen = {}, set()
    for i in range(n):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            seen |= group
            numbers = [rows[k][0] for k in group if rows[k][0] is not None]
            for k in group:
                found[k] = (len(links[k]), min(numbers) if numbers else None)
    return found


def check(found, rows, least=0.9):
    wanted = brute(rows, least)
    got = sorted(str((r["vec_id"], r["n_links"], r["component_id"], r["kept"])) for r in found)
    assert got == sorted(str((rows[k][0], *wanted[k], rows[k][0] == wanted[k][1])) for k in wanted)


def test_odd_vectors(rows):
    given = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]),
        (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0, 0.05, 0.0]),
        (12, [-1.0, 0.0]), (2, [1.0, 0.0]), (None, [0.0, 1.0]), (14, [0.05, 1.0]), (None, [5.0, -5.0]),
    ]
    check(vectors.near_duplicate_vectors(rows(ROWS, *[(*r, 0) for r in given])).collect(), given)


def test_clusters_in_many_blocks(rows, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    random = np.random.default_rng(5)
    centres = random.normal(size=(6, 24))
    near = [c + random.normal(scale=0.2, size=24) for c in centres for _ in range(40)]
    alone = [random.normal(size=24) for _ in range(60)]
    given = [(k, [float(np.float32(v)) for v in x]) for k, x in enumerate([*near, *alone, *alone[:5]])]
    found = vectors.near_duplicate_vectors(rows(ROWS, *[(*r, 0) for r in given]).repartition(5)).collect()
    wanted = brute(given)
    total = sum(w[0] for w in wanted.values())
    assert 0.98 * total <= sum(r["n_links"] for r in found) <= total
    assert all(r["n_links"] <= wanted[r["vec_id"]][0] for r in found)
    assert len({r["component_id"] for r in found}) >= len({w[1] for w in wanted.values()})


def test_codes_never_hide_a_neighbour():
    """The looked-up distance, less the error of the codes, is no more than the true one."""
    random = np.random.default_rng(6)
    x = random.normal(size=(500, 20))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = vectors.fit(x, len(x))
    lists, codes, error = vectors.encode(index, x)
    step = index.codes.shape[2]
    kept = index.lists[lists] + np.hstack([index.codes[s][codes[:, s]] for s in range(len(index.codes))])
    assert kept.shape[1] == step * vectors.SUBSPACES
    wide = vectors._widened(index, x)
    assert np.allclose(np.linalg.norm(wide - kept, axis=1), error)
    for q in range(0, 500, 50):
        true = np.linalg.norm(x - x[q], axis=1)
        assert (np.linalg.norm(wide[q] - kept, axis=1) - error <= true + 1e-9).all()


def test_recall_on_planted_pairs():
    random = np.random.default_rng(7)
    x = random.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = random.normal(size=(500, 64))
    noise -= (noise * x[:500]).sum(axis=1)[:, None] * x[:500]
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cosine = random.uniform(0.9, 0.93, 500)[:, None]
    found, visits = vectors.recall(random.permutation(np.vstack([x, cosine * x[:500] + np.sqrt(1 - cosine**2) * noise])))
    assert found >= 0.95 and visits < 32


def correlated(n, pairs, width, seed, power=1):
    """Unit vectors whose coordinates decay as 1/k^power, and copies of some at cosines of 0.9 to 0.93."""
    random, scale = np.random.default_rng(seed), 1 / np.arange(1, width + 1) ** power
    x = random.normal(size=(n, width)) * scale
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = random.normal(size=(pairs, width)) * scale
    noise -= (noise * x[:pairs]).sum(axis=1)[:, None] * x[:pairs]
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cosine = random.uniform(0.9, 0.93, pairs)[:, None]
    return random.permutation(np.vstack([x, cosine * x[:pairs] + np.sqrt(1 - cosine**2) * noise]))


@pytest.mark.parametrize("power, most", [(0, 12), (0.5, 11), (1, 10)])
def test_reach_is_fitted_to_the_vectors(power, most):
    """At cosines from 0.9 to 0.93; half the distance of a link as reach takes 40, 13 and 9 visits."""
    found, visits = vectors.recall(correlated(8000, 1000, 64, 8, power))
    assert found >= 0.999 and visits < most


def test_reach_of_few_and_equal_vectors():
    half = np.sqrt(0.2) / 2
    one = np.eye(4)[:1]
    assert vectors.fit(one, 1).reach == pytest.approx(half)
    assert vectors.fit(np.repeat(one, 3, 0), 3).reach == pytest.approx(half)
    assert 0 <= vectors.fit(np.eye(4), 4).reach <= half


@pytest.mark.parametrize("width", [64, 384])
def test_recall_on_correlated_vectors(width):
    assert vectors.recall(correlated(3000, 500, width, 8))[0] == 1


def test_links_of_correlated_vectors_are_counted_once(rows):
    given = [(k, [float(np.float32(v)) for v in x]) for k, x in enumerate(correlated(400, 100, 48, 9))]
    check(vectors.near_duplicate_vectors(rows(ROWS, *[(*r, 0) for r in given])).collect(), given)


def test_no_vectors_and_only_bad_ones(rows):
    bad = rows(ROWS, (1, None, 1), (2, [0.0], 1))
    assert vectors.near_duplicate_vectors(bad.where("false")).collect() == []
    check(vectors.near_duplicate_vectors(bad).collect(), [(1, None), (2, [0.0])])


@pytest.mark.parametrize("name", ["key", "unit", "row"])
def test_clashing_columns(rows, name):
    given = rows(f"vec_id long, embedding array<double>, {name} string", (1, [1.0, 2.0], "x"), (2, [1.0, 2.1], "x"))
    assert [r["n_links"] for r in vectors.near_duplicate_vectors(given).collect()] == [1, 1]


def test_query_equals_brute_force(spark, given):
    table = given("embeddings").collect()
    check(QUERIES["op10_embedding_near_dedup"](spark, FOLDER).collect(), [(r["vec_id"], r["embedding"]) for r in table])

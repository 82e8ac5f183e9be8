"""Near-duplicate vectors by product quantisation.

Vectors are put into the inverted list of their nearest coarse centroid. What remains is cut into
subspaces, each replaced by the number of its nearest code. A query probes the lists that a neighbour
may lie in, looks distances up in tables of its own, and compares exactly where the looked-up distance,
less the error that the codes of that vector are known to have, allows a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import stored
from hirelake.llm.components import components

LEAST_COSINE = 0.9
SAMPLE = 1 << 14  # vectors that centroids and codes are fitted on: those with the smallest hashes
SUBSPACES, CODES, ROUNDS = 8, 32, 8
LEAST_LISTS, MOST_LISTS = 8, 4096
BLOCK = 512  # about as many vectors of one list are held in memory while queries pass by
ROUNDING = 1e-6
PLANTED = 1 << 15  # about as many links are planted into the sample to learn how far borders are crossed


class Index(NamedTuple):
    """Coarse centroids, and for every subspace its codes."""

    lists: np.ndarray
    codes: np.ndarray  # subspace, code, coordinate
    reach: float  # vectors this close to the border of another list visit it

    @property
    def width(self) -> int:
        return self.codes.shape[0] * self.codes.shape[2]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1)


def _k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    random = np.random.default_rng(seed)
    centres = x[random.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        nearest = _nearest(x, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def fit(x: np.ndarray, rows: int, least: float = LEAST_COSINE) -> Index:
    """From a sample of unit vectors; the number of lists grows with the root of the number of rows.

    Of two linked vectors in two lists one lies within half their distance of the border between these,
    but seldom so far: a link leads across a border in a slanting direction. How far is learnt from links
    planted into the sample, all of the smallest cosine there is; the farthest any of them needs is the reach.
    """
    lists = int(np.clip(2 ** np.round(np.log2(max(rows, 1)) / 2), LEAST_LISTS, MOST_LISTS))
    step = -(-x.shape[1] // SUBSPACES)
    wide = np.zeros((len(x), step * SUBSPACES))
    wide[:, : x.shape[1]] = x
    centres = _k_means(wide, lists, 1)
    rest = wide - centres[_nearest(wide, centres)]
    parts = rest.reshape(len(x), SUBSPACES, step)
    codes = [_k_means(parts[:, s], CODES, 2 + s) for s in range(SUBSPACES)]
    return Index(centres, np.array(codes), _reach(centres, wide, least))


def _reach(centres: np.ndarray, x: np.ndarray, least: float) -> float:
    """The largest distance from a border at which one end of each planted link lies, at most half a link.

    A link leads from a vector of the sample in the direction in which two others of it differ.
    """
    random = np.random.default_rng(SUBSPACES + 2)
    half = float(np.sqrt(max(2 - 2 * least, 0.0))) / 2
    most, met = 0.0, 0
    for _ in range(-(-PLANTED // len(x))):
        for at in range(0, len(x), BLOCK):
            one = x[at : at + BLOCK]
            ends = random.integers(0, len(x), (2, len(one)))
            across = x[ends[0]] - x[ends[1]]
            across -= np.einsum("ij,ij->i", across, one)[:, None] * one
            size = np.sqrt(np.einsum("ij,ij->i", across, across))
            real = size > 1e-9
            one, across = one[real], across[real] / size[real, None]
            other = least * one + np.sqrt(max(1 - least * least, 0.0)) * across
            a, b = _nearest(one, centres), _nearest(other, centres)
            apart = a != b
            if apart.any():
                needed = np.minimum(
                    _to_border(centres, one[apart], a[apart], b[apart]), _to_border(centres, other[apart], b[apart], a[apart])
                )
                most = max(most, float(needed.max()))
            met += len(one)
    return min(most, half) if met else half


def encode(index: Index, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """List, codes and length of the error of each vector."""
    wide = _widened(index, x)
    lists = _nearest(wide, index.lists)
    rest = wide - index.lists[lists]
    parts = rest.reshape(len(x), *index.codes.shape[::2])
    codes = np.stack([_nearest(parts[:, s], index.codes[s]) for s in range(len(index.codes))], axis=1)
    kept = np.stack([index.codes[s][codes[:, s]] for s in range(len(index.codes))], axis=1)
    return lists, codes.astype(np.uint8), np.sqrt(((parts - kept) ** 2).sum(axis=(1, 2)))


def _to_border(centres: np.ndarray, wide: np.ndarray, own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How far each vector, of list ``own``, is from the border to the other list.

    Rows are computed one by one, so that the answer is the same wherever it is asked.
    """
    apart = centres[own] - centres[others]
    middle = (centres[own] + centres[others]) / 2
    gaps = np.sqrt(np.maximum(np.einsum("ij,ij->i", apart, apart), 1e-24))
    return np.einsum("ij,ij->i", wide - middle, apart) / gaps


def _near_border(index: Index, wide: np.ndarray, own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether each vector lies within the reach of the border to the other list."""
    return _to_border(index.lists, wide, own, others) <= index.reach + ROUNDING


def probed(index: Index, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, list) pairs: the query's own list and those whose border lies within the reach."""
    wide = _widened(index, x)
    squares = _squares(wide, index.lists)
    gaps = np.sqrt(np.maximum(_squares(index.lists, index.lists), 1e-24))
    over = (squares - squares[np.arange(len(x)), own][:, None]) / (2 * gaps[own])
    query, list_ = np.nonzero((over <= index.reach + 2 * ROUNDING) | (gaps[own] <= 1e-6) | (np.arange(len(index.lists)) == own[:, None]))
    visits = list_ == own[query]
    for at in range(0, len(query), 65536):
        q, other = query[at : at + 65536], list_[at : at + 65536]
        visits[at : at + 65536] |= _near_border(index, wide[q], own[q], other)
    return query[visits], list_[visits]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1)


def _widened(index: Index, x: np.ndarray) -> np.ndarray:
    """As wide as the index; what a longer vector has beyond that is not looked up, only compared."""
    wide = np.zeros((len(x), index.width))
    wide[:, : x.shape[1]] = x[:, : index.width]
    return wide


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the unit vector as bytes; NULL where a vector can't link."""
    for batch in batches:
        units = []
        for vector in batch.column(1):
            x = np.array([] if vector.as_py() is None else vector.as_py(), np.float64)  # NULL becomes NaN
            largest = np.abs(x).max() if len(x) else 0.0
            if np.isfinite(largest) and largest > 0:
                x = x / largest
                units.append((x / np.sqrt(x @ x)).astype("<f8").tobytes())
            else:
                units.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.binary())], ["vec_id", "unit"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, from bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(u) for u in batch.column(column).to_pylist()])
    for size in np.unique(sizes):
        yield batch.filter(pa.array(sizes == size))


def _links(queries: np.ndarray, members: dict, index: Index, centre: np.ndarray, apart: float, least: float) -> tuple:
    """(query, member) pairs of one block that link."""
    pairs = []
    for size, block in members.items():
        if size != queries.shape[1]:
            continue
        rest = (_widened(index, queries) - centre).reshape(len(queries), *index.codes.shape[::2])
        looked_up = np.zeros((len(queries), len(block["codes"])))
        for s, codes in enumerate(index.codes):
            looked_up += np.maximum(_squares(rest[:, s], codes), 0)[:, block["codes"][:, s]]
        q, m = np.nonzero(np.sqrt(looked_up) <= apart + block["error"] + ROUNDING)
        exact = np.concatenate(
            [np.einsum("ij,ij->i", queries[q[k : k + 65536]], block["x"][m[k : k + 65536]]) for k in range(0, len(q), 65536)]
            or [np.empty(0)]
        )
        close = exact >= least
        pairs.append((q[close], block["at"][m[close]]))
    return tuple(np.concatenate(p) for p in zip(*pairs)) if pairs else (np.empty(0, int), np.empty(0, int))


def _compare(index, apart: float, least: float):
    """Rows sorted by (list, block, kind): members of a block first, then the queries that visit it.

    Gives (key, other, links): links to be added to a vector's, or a link between two vectors. Links are
    counted here; of a block's links those that connect it are listed, not all of them.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, members = None, [], None
        for batch in batches:
            lists, blocks, kinds = (batch.column(c).to_numpy() for c in ("list", "block", "kind"))
            changes = (lists[1:] != lists[:-1]) | (blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])
            starts = np.r_[0, np.flatnonzero(changes) + 1, len(lists)]
            for start, end in zip(starts[:-1], starts[1:]):
                if end == start:
                    continue
                part, here = batch.slice(start, end - start), (lists[start], blocks[start])
                if here != at:
                    at, rows, members = here, [], None
                if kinds[start] == 0:
                    rows.append(part)
                    continue
                if members is None:
                    members = _block(index.value, pa.Table.from_batches(rows).combine_chunks()) if rows else ({}, [], [])
                yield from _met(index.value, members, part, int(here[0]), apart, least)

    return compared


def _block(index: Index, table: pa.Table) -> tuple[dict, np.ndarray, np.ndarray]:
    """Members by length of vector, with their codes; their keys and sizes."""
    batch = table.to_batches()[0]
    sizes = np.array([len(u) for u in batch.column("unit").to_pylist()])
    members = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        some = batch.take(pa.array(at))
        codes = np.frombuffer(b"".join(some.column("codes").to_pylist()), np.uint8).reshape(len(at), -1)
        members[int(size) // 8] = {
            "at": at, "x": _matrix(some.column("unit")), "codes": codes, "error": some.column("error").to_numpy(),
        }
    return members, batch.column("key").to_numpy(), batch.column("size").to_numpy()


def _met(index, members, queries, list_: int, apart: float, least: float) -> Iterator[pa.RecordBatch]:
    blocks, keys, sizes = members
    for at in range(0, queries.num_rows, BLOCK):
        for part in _by_length(queries.slice(at, BLOCK), "unit"):
            x = _matrix(part.column("unit"))
            query_keys, query_sizes = part.column("key").to_numpy(), part.column("size").to_numpy()
            own = part.column("own").to_numpy()
            q, m = _links(x, blocks, index, index.lists[list_], apart, least)
            q, m = _met_once(index, blocks, x, own, query_keys, keys, q, m, list_)
            if not len(q):
                continue
            gained = np.bincount(q, sizes[m], part.num_rows).astype(np.int64)
            given = np.bincount(m, query_sizes[q], len(keys)).astype(np.int64)
            counted = np.r_[query_keys[gained > 0], keys[given > 0]]
            links = np.r_[gained[gained > 0], given[given > 0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(counted), pa.nulls(len(counted), pa.int64()), pa.array(links)], ["key", "other", "links"]
            )
            a, b = _spanning(q, m, len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_keys[a]), pa.array(keys[b]), pa.nulls(len(a), pa.int64())], ["key", "other", "links"]
            )


def _met_once(index, blocks, x, own, query_keys, keys, q, m, list_: int) -> tuple[np.ndarray, np.ndarray]:
    """The links that count here: in one list the smaller key's, in two the earlier list's visit if both visit."""
    if not len(q):
        return q, m
    once = (own[q] < list_) | ((own[q] == list_) & (query_keys[q] < keys[m]))
    later = np.flatnonzero(own[q] > list_)
    block = blocks[x.shape[1]]
    for at in range(0, len(later), 65536):
        some = later[at : at + 65536]
        members = _widened(index, block["x"][np.searchsorted(block["at"], m[some])])
        here = np.full(len(some), list_)
        once[some] = ~_near_border(index, members, here, own[q[some]])
    return q[once], m[once]


def _spanning(q: np.ndarray, m: np.ndarray, members: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (q, m), sorted by q, enough to connect what they connect."""
    label, first, second = np.arange(members), [], []
    for one in np.split(np.arange(len(q)), np.flatnonzero(np.diff(q)) + 1):
        linked = m[one]
        groups, where = np.unique(label[linked], return_index=True)
        first.append(np.full(len(groups), q[one[0]]))
        second.append(linked[where])
        if len(groups) > 1:
            label[np.isin(label, groups)] = groups[0]
    return np.concatenate(first), np.concatenate(second)


def near_duplicate_vectors(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = LEAST_COSINE
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    Vectors link at a cosine of ``least`` or more, computed in double precision; none below it is ever
    linked. Of those above it a link is found where one of two vectors visits the other's list: all planted
    ones of the fitting sample (``recall`` measures it). Equal vectors are compared as one. Vectors that are NULL, empty, zero or hold NULL, NaN or an infinity link with nothing, nor do
    vectors of different lengths. n_links counts rows; component_id is the smallest vec_id reachable,
    and kept tells whether it is the row's own. A row without vec_id takes part; its component has the
    smallest vec_id there is. Rows that repeat a vec_id are separate rows. Other columns are ignored; an
    empty table gives an empty table.
    """
    spark = rows.sparkSession
    apart = float(np.sqrt(max(2 - 2 * least, 0.0)))
    given = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    units = given.mapInArrow(_units, "vec_id long, unit binary").withColumn("row", F.monotonically_increasing_id())
    units = stored(units, "units")
    classes = units.where("unit IS NOT NULL").groupBy("unit").agg(
        F.min("row").alias("key"), F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("size")
    )
    classes = stored(classes, "vectors")
    sample = classes.orderBy(F.xxhash64("unit"), "key").limit(SAMPLE).select("unit").collect()
    if not sample:
        return units.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    vectors = [np.frombuffer(r["unit"], "<f8") for r in sample]
    wide = np.zeros((len(vectors), max(map(len, vectors))))
    for k, x in enumerate(vectors):
        wide[k, : len(x)] = x
    fitted = fit(wide, classes.count(), least)
    index = spark.sparkContext.broadcast(fitted)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_length(batch, "unit"):
                lists, codes, error = encode(index.value, _matrix(part.column("unit")))
                columns = [pa.array(lists), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *columns], ["key", "size", "unit", "own", "codes", "error"]
                )

    def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole, "unit"):
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    own = part.column("own").to_numpy()
                    query, list_ = probed(index.value, _matrix(part.column("unit")), own)
                    taken = part.take(pa.array(query))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(list_)], ["key", "size", "unit", "own", "list"])

    kinds = "key long, size long, unit binary, own long"
    coded_rows = stored(classes.select("key", "size", "unit").mapInArrow(coded, f"{kinds}, codes binary, error double"), "coded")
    # At most as many rows as there are lists: how many blocks each is cut into.
    cut = coded_rows.groupBy(F.col("own").alias("list")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    cut = F.broadcast(stored(cut, "lists"))
    members = coded_rows.withColumn("list", F.col("own")).join(cut, "list")
    members = members.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks"))).withColumn("kind", F.lit(0))
    visitors = coded_rows.select("key", "size", "unit", "own").mapInArrow(visiting, f"{kinds}, list long").join(cut, "list")
    visitors = visitors.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    visitors = visitors.withColumns(
        {"kind": F.lit(1), "codes": F.lit(None).cast("binary"), "error": F.lit(None).cast("double")}
    )
    columns = ["list", "block", "kind", "key", "size", "unit", "own", "codes", "error"]
    met = members.select(columns).unionByName(visitors.select(columns))
    met = met.repartition("list", "block").sortWithinPartitions("list", "block", "kind")
    found = stored(met.mapInArrow(_compare(index, apart, least), "key long, other long, links long"), "found")
    links = found.where("links IS NOT NULL").groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL").select(F.col("key").alias("u"), F.col("other").alias("v")))
    rooted = classes.select("key", "first", "size", "unit").join(links, "key", "left")
    rooted = rooted.join(roots.withColumnRenamed("node", "key"), "key", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "key"))
    rooted = stored(rooted.select("unit", "first", "size", "links", "root"), "rooted")
    least_id = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least_id, "root").select(
        "unit", "component_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    linked = units.where("unit IS NOT NULL").join(named, "unit").select("vec_id", "n_links", "component_id")
    alone = units.where("unit IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def recall(x: np.ndarray, least: float = LEAST_COSINE) -> tuple[float, float]:
    """Share of linked pairs of the unit vectors ``x`` that share a visited list, and visits per vector."""
    index = fit(x[:SAMPLE], len(x), least)
    own, _, _ = encode(index, x)
    visits = np.zeros((len(x), len(index.lists)), bool)
    for at in range(0, len(x), BLOCK):
        q, list_ = probed(index, x[at : at + BLOCK], own[at : at + BLOCK])
        visits[at + q, list_] = True
    found = total = 0
    for at in range(0, len(x), BLOCK):
        a, b = np.nonzero(x[at : at + BLOCK] @ x.T >= least)
        a, b = (a + at)[a + at < b], b[a + at < b]
        found += int((visits[a, own[b]] | visits[b, own[a]]).sum())
        total += len(a)
    return found / max(total, 1), float(visits.sum(axis=1).mean())

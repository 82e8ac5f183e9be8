"""SimHash near-duplicates: fingerprints that differ in few bits, found by Golay-code keys.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. At most four differing bits leave
either one segment equal and another with at most two differing bits, or two segments with exactly one
each. The first case shares a key made of the equal segment and a Golay index of the other; the second
shares a key of two Golay indices, where the word of even parity needs its own index only, for the
other's parity is odd. Distinct fingerprints that share a key are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import some_rows, spare, stored
from hirelake.llm.components import components
from hirelake.llm.golay import near_indices

SHINGLE, BITS_APART = 4, 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, number of bits
# Distinct fingerprints of one key that are compared with each other in one task; more take the exact
# way through midpoints, which never brings many together.
MOST_COMPARED = 1 << 15
SEED = 42


def simhash(text: str | None, width: int) -> int:
    """Fingerprint of one text; 0 without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > width:
        spans = zip(starts[: 1 - width].tolist() if width > 1 else starts.tolist(), ends[width - 1 :].tolist())
        shingles = [joined[a:b] for a, b in spans]
    else:
        shingles = [joined]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(set_bits * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(
    docs: DataFrame, text: str = "text", width: int = SHINGLE, name: str = "fingerprint", keep_text: bool = True
) -> DataFrame:
    """Adds the 64-bit SimHash of the shingles of ``width`` words, as a signed long.

    Words are what blanks and the control characters 9 to 13 separate, with A-Z lower-cased. Repeated
    shingles count as often as they occur. A text of fewer words is one shingle; one without words, or
    NULL, has the fingerprint 0. A column of the same name is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != name.lower() and (keep_text or c != text)]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in some_rows(whole):
                found = [simhash(t.as_py(), width) for t in batch.column(text)]
                columns = [batch.column(c) for c in kept] + [pa.array(found, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, name])

    needed = list(dict.fromkeys([*kept, text]))
    return docs.select(*needed).mapInArrow(hashed, schema)


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of 64-bit fingerprints, and the position of the fingerprint each key belongs to."""
    prints = prints.view(np.uint64)
    segments = [((prints >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    near = [near_indices(s) for s in segments]
    odd = [np.bitwise_count(s) & 1 for s in segments]
    keys, owners = [], []

    def add(tag: int, key: np.ndarray, counts: np.ndarray) -> None:
        flat = counts.reshape(len(prints), -1)
        owner, column = np.nonzero(flat)
        keys.append(key.reshape(len(prints), -1)[owner, column] | tag << 40)
        owners.append(owner)

    own = np.arange(6)[None, :] == 0
    for i in range(3):
        for j in range(3):
            if i != j:
                add(3 * i + j, segments[i][:, None] << 12 | near[j][0], near[j][1])
            if i < j:
                first = near[i][1] & (own | (odd[i] == 1)[:, None])
                second = near[j][1] & (own | (odd[j] == 1)[:, None])
                parity = (odd[i] ^ odd[j]).astype(np.int64)[:, None, None] << 24
                key = near[i][0][:, :, None] << 12 | near[j][0][:, None, :] | parity
                add(9 + 3 * i + j, key, first[:, :, None] & second[:, None, :])
    return np.concatenate(keys), np.concatenate(owners)


def _long_table(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: pa.array(values) for name, values in columns.items()})


def _keyed(classes: DataFrame, heavy: np.ndarray) -> DataFrame:
    """(key, print) for every key; for a heavy key (None, print), which goes the way of the midpoints."""

    def keyed(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(prints), 1 << 13):
                part = prints[at : at + (1 << 13)]
                if len(part):
                    keys, owners = golay_keys(part)
                    at_heavy = np.isin(keys, heavy)
                    if at_heavy.any():
                        hot = part[np.unique(owners[at_heavy])]
                        yield pa.RecordBatch.from_arrays(
                            [pa.nulls(len(hot), pa.int64()), pa.array(hot)], ["key", "print"]
                        )
                    yield _long_table(key=keys[~at_heavy], print=part[owners[~at_heavy]])

    return classes.select("print").mapInArrow(keyed, "key long, print long")


def _spanning(prints: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links of at most ``apart`` bits connect, one per print at most."""
    prints, first, second = np.unique(prints).view(np.uint64), [], []
    left = prints
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            close = np.bitwise_count(left ^ at) <= apart
            if close.any():
                found, left = left[close], left[~close]
                first.append(np.full(len(found), at))
                second.append(found)
                frontier.extend(found)
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *first]).view(np.int64), np.concatenate([empty, *second]).view(np.int64)


def _links_of_runs(apart: int, most: int):
    """Reads rows sorted by key; gives (u, v) links, and (print, NULL) for members of too long runs."""

    def complete(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        lengths = np.diff(np.r_[starts, len(keys)])
        us, vs = [], []
        pairs = starts[lengths == 2]
        a, b = prints[pairs], prints[pairs + 1]
        close = np.bitwise_count((a ^ b).view(np.uint64)) <= apart
        us.append(a[close])
        vs.append(b[close])
        for start, length in zip(starts[lengths > 2].tolist(), lengths[lengths > 2].tolist()):
            u, v = _spanning(prints[start : start + length], apart)
            us.append(u)
            vs.append(v)
        yield _long_table(u=np.concatenate(us), v=np.concatenate(vs))

    def links(batches):
        held_key, held, overflow = None, [], False
        for batch in batches:
            keys, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1], "left"))  # where the run that may go on begins
            if held_key is not None and keys[0] == held_key:
                first = int(np.searchsorted(keys, held_key, "right"))
                held.append(prints[:first])
            else:
                first = 0
            if held_key is not None and keys[-1] != held_key:  # the held run has ended
                run = np.concatenate(held)
                if overflow:
                    yield _overflown(run)
                elif len(run) > 1:
                    u, v = _spanning(run, apart)
                    yield _long_table(u=u, v=v)
                held, overflow = [], False
            if keys[-1] != held_key:
                if last > first:
                    yield from complete(keys[first:last], prints[first:last])
                held_key, held = keys[-1], [prints[last:]]
            if sum(map(len, held)) > most:
                overflow = True
            if overflow:
                yield _overflown(np.concatenate(held))
                held = [np.empty(0, np.int64)]
        if held_key is not None and held:
            run = np.concatenate(held)
            if overflow:
                yield _overflown(run)
            elif len(run) > 1:
                u, v = _spanning(run, apart)
                yield _long_table(u=u, v=v)

    return links


def _overflown(run: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(run), pa.nulls(len(run), pa.int64())], ["u", "v"])


def _midpoints(apart: int):
    """All words within half of ``apart`` bits: prints link if and only if they have one in common."""
    masks = [0]
    for _ in range(apart // 2):
        masks = sorted({m ^ (1 << b) for m in masks for b in range(64)} | set(masks))
    masks = np.array(masks, np.uint64)

    def spread(batches):
        for batch in batches:
            for print_ in batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64):
                words = (masks ^ print_).view(np.int64)
                yield _long_table(mid=words, print=np.full(len(words), print_).view(np.int64))

    return spread


def heavy_keys(classes: DataFrame, sample: int = 256, least: int = 128, share: int = 1000) -> np.ndarray:
    """Keys that hold so many fingerprints that they shouldn't meet in one task; at most 62 x ``share``.

    Counted on every ``sample``-th fingerprint; a key counts as heavy from ``least`` of them and from
    one in ``share``. This only chooses the way on which links are found, not the links.
    """
    some = stored(classes.where(F.pmod(F.xxhash64("print"), F.lit(sample)) == 0), "sample")
    n = some.count()
    counts = _keyed(some, np.empty(0, np.int64)).groupBy("key").count()
    rows = counts.where(F.col("count") >= max(least, n / share)).select("key").collect()
    return np.array([r["key"] for r in rows], np.int64)


def links(classes: DataFrame, apart: int = BITS_APART, most: int = MOST_COMPARED) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``print`` that connect all that differ in at most
    ``apart`` (four or fewer) bits.

    Not every link is listed, but the components are the same as if it were: among those that share a
    key only a spanning forest is given. Keys of very many fingerprints go through midpoints instead:
    fingerprints within four bits of each other, and only they, share a word within two bits of both,
    and a word has no more than 2,081 fingerprints that close.
    """
    if not 0 <= apart <= 4:
        raise ValueError("the keys are made for at most four differing bits")
    heavy = heavy_keys(classes)
    keyed = _keyed(classes, heavy)
    if len(heavy):
        keyed = stored(keyed, "keys")
    runs = keyed.where("key IS NOT NULL").repartition("key").sortWithinPartitions("key", "print")
    found = stored(runs.mapInArrow(_links_of_runs(apart, most), "u long, v long"), "links")
    hot = found.where("v IS NULL").select(F.col("u").alias("print"))
    if len(heavy):
        hot = hot.unionByName(keyed.where("key IS NULL").select("print"))
    # The words within half the bits rounded down; an odd number of bits is taken up to the next even
    # one and its links are checked below.
    even = apart + apart % 2
    mids = hot.distinct().mapInArrow(_midpoints(even), "mid long, print long")
    stars = mids.groupBy("mid").agg(F.collect_set("print").alias("prints")).where(F.size("prints") > 1)
    if apart % 2:
        pairs = stars.select(F.explode("prints").alias("u"), "prints").select("u", F.explode("prints").alias("v"))
        stars = pairs.where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= apart))
    else:
        stars = stars.select(F.array_min("prints").alias("u"), F.explode("prints").alias("v")).where("u <> v")
    return found.where("v IS NOT NULL").unionByName(stars.select("u", "v")).distinct()


def near_duplicate_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    apart: int = BITS_APART,
    keep_text: bool = True,
) -> DataFrame:
    """Adds ``fingerprint`` (16 hex digits), ``component_id`` and ``kept`` to every row.

    Fingerprints link at ``apart`` or fewer differing bits; texts with equal fingerprints, among them
    all without words, are linked as well. ``component_id`` is the smallest number reachable by links,
    NULL if nothing reachable has one. ``kept`` is true for one row of each group: one with that
    number, also where rows repeat. Columns of these names are replaced; an empty table gives an empty
    table; repeated rows stay as often as they come.
    """
    added = ["fingerprint", "component_id", "kept"]
    base = docs.select(*[c for c in docs.columns if c.lower() not in added])
    print_, row = spare([*base.columns, *added], "print"), spare([*base.columns, *added], "row")
    hashed = with_fingerprints(base, text, width, print_, keep_text)
    prints = stored(hashed.withColumn(row, F.monotonically_increasing_id()), "prints")
    # Numbers come before no number, then the row numbers that the stored table fixes.
    first = F.min(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row")))
    classes = stored(prints.groupBy(F.col(print_).alias("print")).agg(first.alias("first")), "classes")
    roots = components(links(classes.select("print"), apart))
    rooted = classes.join(roots, classes["print"] == roots["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    rooted = stored(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    named = rooted.select("print", "root").join(least, "root").select(F.col("print").alias(print_), "first")
    return prints.join(stored(named, "named"), print_).select(
        *[c for c in prints.columns if c not in (print_, row)],
        F.lower(F.lpad(F.hex(print_), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        (F.col("first.row") == F.col(row)).alias("kept"),
    )


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, apart: int = BITS_APART
) -> DataFrame:
    """One document of each group of ``near_duplicate_groups``: the one with the smallest number.

    Columns stay as they were. Of repeated rows one stays, and so it does of all texts without words; a row
    without a number stays only if nothing it is linked with has one. An empty table stays empty.
    """
    inner = spare(docs.columns, "doc")
    packed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.struct("*").alias(inner))
    groups = near_duplicate_groups(packed, width=width, apart=apart, keep_text=False)
    return groups.where("kept").select(f"{inner}.*")

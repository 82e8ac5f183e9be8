"""Document fingerprints that tell versions apart: invertible Bloom lookup sketches of paragraphs.

A text is the set of its paragraphs, each with how often it occurs; every element is a 64-bit digest. A
sketch has three rows of cells; a digest falls into one cell of each row, and a cell holds the number of
its digests and the exclusive ors of them and of their check hashes. Subtracting the sketches of two
versions cancels what they share. A cell that is left with one digest reveals it; taking that digest out
of its other cells reveals more, until all cells are empty: then the differing digests are known. If
some cells stay full, both sketches are taken larger.

Everything is DataFrame functions. The elements and cells of one text lie in one partition, so that no
round of the peeling needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import stored

# Digests that one task turns into cells: what it holds of them fits into memory without spilling.
DIGESTS_PER_TASK = 400_000
ROWS = 3  # of cells: a digest has one cell in each
LEAST_CELLS, LARGER = 8, 4  # cells of a row in the published sketch; how much larger every retry is
# Turns over the rows of cells; a sketch that is large enough is empty after a few of them.
TURNS = 4
# A paragraph is a line; a longer one is cut, so that a text of one line has parts too.
PARAGRAPH_CHARS = 200
CHECK_SEED, CELL_SEED = 1_000_003, 17


def paragraphs(text: Column) -> Column:
    """Digests of the paragraphs of a text; blank lines are none."""
    lines = F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{PARAGRAPH_CHARS}}}"), F.lit(0))
    return F.transform(lines, lambda line: F.xxhash64(line))


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit(CHECK_SEED), digest)


def _cell(digest: Column, row: int, cells: Column) -> Column:
    """Place of a digest's cell in a row of cells; rows follow one another."""
    return F.pmod(F.xxhash64(F.lit(CELL_SEED + row), digest), cells) + row * cells


def elements(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct elements (keys, digest) of rows (keys, digests): a paragraph with its number of uses."""
    each = versions.select(*keys, F.explode("digests").alias("paragraph"))
    counted = each.groupBy(*keys, "paragraph").agg(F.count(F.lit(1)).alias("uses"))
    return counted.select(*keys, F.xxhash64("paragraph", "uses").alias("digest"))


def _summed(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Cells from entries (keys, cells, cell, n, digest, check); empty cells are left out."""
    cells = entries.groupBy(*keys, "cells", "cell").agg(
        F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check")
    )
    return cells.where((F.col("n") != 0) | (F.col("digest") != 0) | (F.col("check") != 0))


def sketch(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of the sketches of elements (keys, cells, digest); ``cells`` is the length of a row."""
    digest, cells = F.col("digest"), F.col("cells")
    places = F.array(*[_cell(digest, row, cells) for row in range(ROWS)])
    entries = parts.select(*keys, "cells", F.explode(places).alias("cell"), "digest").withColumns(
        {"n": F.lit(1).cast("long"), "check": _check(digest)}
    )
    return _summed(entries, keys)


def peel(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Reveals digests row by row: returns (keys, cells, revealed, left).

    ``revealed`` lists the digests that were found with their side, 1 for those that only the first
    version has and -1 for the second; ``left`` is the number of cells that are still full. A digest has
    one cell in a row, so it is revealed once, and taken out of its cells in other rows.
    """
    # Revealed digests stay among the cells, in places of their own below 0, told apart by ``seen``.
    state = cells.withColumn("seen", F.lit(None).cast("long"))
    for turn in range(TURNS * ROWS):
        row = turn % ROWS
        pure = (
            (F.floor(F.col("cell") / F.col("cells")) == row)
            & (F.abs("n") == 1)
            & (F.col("check") == _check(F.col("digest")))
            & (F.col("cell") == _cell(F.col("digest"), row, F.col("cells")))
        )
        entry = lambda cell, n, seen: F.struct(
            cell.alias("cell"), n.alias("n"), "digest", "check", seen.cast("long").alias("seen")
        )
        others = [
            entry(_cell(F.col("digest"), other, F.col("cells")), -F.col("n"), F.lit(None)) for other in range(ROWS) if other != row
        ]
        # The revealed cell becomes empty, and its digest and side an entry that no cell has.
        found = entry(F.lit(-1).cast("long"), F.col("n"), F.col("digest"))
        same = entry(F.col("cell"), F.col("n"), F.col("seen"))
        spread = state.select(
            *keys, "cells", F.explode(F.when(pure, F.array(found, *others)).otherwise(F.array(same))).alias("e")
        )
        state = (
            spread.select(*keys, "cells", "e.*")
            .groupBy(*keys, "cells", "cell", "seen")
            .agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check"))
            .where((F.col("n") != 0) | (F.col("digest") != 0) | (F.col("check") != 0))
        )
    revealed = F.when(F.col("cell") < 0, F.struct("digest", F.col("n").cast("int").alias("side")))
    full = (F.col("cell") >= 0).cast("long")
    return state.groupBy(*keys, "cells").agg(F.collect_list(revealed).alias("revealed"), F.sum(full).alias("left"))


def _tasks(rows: DataFrame, digests: Column) -> int:
    """In how many parts rows with that many digests are worked on; 0 without rows."""
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(digests).alias("digests")).first()
    return 0 if not found["rows"] else 1 + int(found["digests"] or 0) // DIGESTS_PER_TASK


def differences(versions: DataFrame) -> DataFrame:
    """(row, pair, revealed): the digests that differ, for rows (row, pair, first, second) of digest lists.

    A digest stands for a paragraph and how often it is used (see ``elements``); its side is 1 where the
    first list has it and -1 where the second has. Sketches start small; pairs whose difference doesn't
    peel try again with larger ones, up to where the row of cells is longer than both lists together,
    which hardly ever fails and is then made larger still. Each try is stored, and the next one reads only
    what is left.
    """
    left, cells, results = stored(versions, "versions"), LEAST_CELLS, None
    nothing = F.array().cast("array<struct<digest:bigint,side:int>>")
    while tasks := _tasks(left, F.size("first") + F.size("second")):
        sides = left.select(
            "row", "pair", F.explode(F.array(
                F.struct(F.lit(1).cast("long").alias("sign"), F.col("first").alias("digests")),
                F.struct(F.lit(-1).cast("long").alias("sign"), F.col("second").alias("digests")),
            )).alias("s"),
        ).repartition(tasks, "row").select("row", "pair", "s.*").withColumn("cells", F.lit(cells).cast("long"))
        parts = elements(sides, ["row", "pair", "sign", "cells"])
        sketched = sketch(parts, ["row", "pair", "sign"])
        subtracted = _summed(sketched.withColumn("n", F.col("n") * F.col("sign")), ["row", "pair"])
        peeled = peel(subtracted, ["row", "pair"])
        tried = left.select("row", "pair").repartition(tasks, "row").join(peeled, ["row", "pair"], "left")
        full = F.coalesce("left", F.lit(0))
        # What a failed try has revealed is found again by the next one.
        kept = F.when(full == 0, F.coalesce("revealed", nothing)).otherwise(nothing)
        tried = stored(tried.select("row", "pair", kept.alias("revealed"), full.alias("left")), "tried")
        done = tried.where("left = 0").select("row", "pair", "revealed")
        results = done if results is None else results.unionByName(done)
        left = stored(left.join(tried.where("left > 0").select("row", "pair"), ["row", "pair"]), "retried")
        cells *= LARGER
    empty = versions.select("row", "pair", nothing.alias("revealed")).where("false")
    return empty if results is None else results


def differing_digests(versions: DataFrame) -> DataFrame:
    """(row, pair, digest, side): a row for each digest that ``differences`` has recovered."""
    return differences(versions).select("row", "pair", F.inline("revealed"))


def published(versions: DataFrame, lists: list[str]) -> DataFrame:
    """(row, and for each of ``lists`` the smallest sketch as a string) of rows with lists of digests.

    Every cell that isn't empty is 28 hexadecimal digits: its place, its number, its digests and the
    lower half of its check hashes. A text without paragraphs has the empty string.
    """
    each = F.array(*[F.struct(F.lit(k).alias("which"), F.col(c).alias("digests")) for k, c in enumerate(lists)])
    tasks = max(1, _tasks(versions, sum(F.size(c) for c in lists)))
    sides = versions.repartition(tasks, "row").select("row", F.explode(each).alias("s")).select("row", "s.*")
    sides = sides.withColumn("cells", F.lit(LEAST_CELLS).cast("long"))
    cells = sketch(elements(sides, ["row", "which", "cells"]), ["row", "which"])
    digits = lambda value, width: F.right(F.lpad(F.hex(value), 16, "0"), F.lit(width))
    cell = F.concat(digits("cell", 2), digits("n", 2), digits("digest", 16), digits("check", 8))
    listed = cells.groupBy("row", "which").agg(F.array_join(F.array_sort(F.collect_list(cell)), "").alias("sketch"))
    wanted = [F.max(F.when(F.col("which") == k, F.col("sketch"))) for k in range(len(lists))]
    found = listed.groupBy("row").agg(*[w.alias(c) for w, c in zip(wanted, lists)])
    everyone = versions.repartition(tasks, "row").select("row").join(found, "row", "left")
    return everyone.select("row", *[F.coalesce(c, F.lit("")).alias(c) for c in lists])


def _place(doc_id: str) -> Column:
    """A document's number as a decimal; without a number it comes below all others."""
    return F.coalesce(F.col(doc_id).cast("long").cast("decimal(20,0)"), _nowhere())


def _nowhere() -> Column:
    return F.lit("-10000000000000000000").cast("decimal(20,0)")


def next_places(places: DataFrame) -> DataFrame:
    """Adds ``next_place``, the next smaller one, to distinct places; after the smallest comes the largest."""
    ranged = range_sorted_down(places)
    inside = ranged.withColumn("next_place", F.lead("place").over(Window.partitionBy("part").orderBy(F.desc("place"))))
    # One row per range, so at most as many as the shuffle has partitions.
    ends = ranged.groupBy("part").agg(F.max("place").alias("top"))
    after = Window.orderBy("part")
    whole = after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lead("top").over(after), F.first("top").over(whole)).alias("top"))
    return inside.join(ends, "part").withColumn("next_place", F.coalesce("next_place", "top")).drop("part", "top")


def range_sorted_down(places: DataFrame) -> DataFrame:
    ranged = places.repartitionByRange(F.desc("place")).withColumn("part", F.spark_partition_id())
    return stored(ranged, "places")


def edited_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_chars, edited_sha256, digests, edited_digests, next_digests), one for each document.

    The edited text has the last third of the characters (rounded down) replaced by as many of the first
    ones of the next document by descending number; after the last comes the first. Of rows that share a
    number the smallest text stands for it as the next document, and each is edited with what follows
    that number. A NULL text is empty, a missing number is the last. Stored.
    """
    # The texts are shuffled once: both joins below read the same exchange, for it has the same columns.
    base = docs.select(_place(doc_id).alias("place"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n_chars = F.length("text").cast("long")
    third = F.floor(n_chars / 3).cast("int")
    places = base.groupBy("place").agg(F.max(third).alias("wanted"))
    following = next_places(places).select(F.col("next_place").alias("place"), F.col("place").alias("for_place"), "wanted")
    head = F.struct(F.substring("text", F.lit(1), F.col("wanted")).alias("head"), paragraphs(F.col("text")).alias("digests"))
    heads = base.join(following, "place").select("for_place", head.alias("next"))
    heads = heads.groupBy(F.col("for_place").alias("place")).agg(F.min("next").alias("next"))
    kept = F.substring("text", F.lit(1), (n_chars - third).cast("int"))
    edited = F.concat(kept, F.substring("next.head", F.lit(1), third))
    number = F.when(F.col("place") > _nowhere(), F.col("place").cast("long"))
    versions = base.join(heads, "place").withColumn("edited", edited).select(
        F.monotonically_increasing_id().alias("row"),
        number.cast(docs.schema[doc_id].dataType).alias("doc_id"),
        n_chars.alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("digests"),
        paragraphs(F.col("edited")).alias("edited_digests"),
        F.col("next.digests").alias("next_digests"),
    )
    return stored(versions, "edited")


def likeness(first: Column, second: Column, differing: Column) -> Column:
    """Share of the distinct paragraphs of both that doesn't differ; 1 if there are none."""
    both = F.size(F.array_distinct(first)) + F.size(F.array_distinct(second))
    return F.when(both == 0, 1.0).otherwise(1 - differing / both).cast("double")


def compared_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of documents and their edited texts, and how alike they and the next document are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. See
    ``edited_documents`` for NULLs and repeated numbers; equal texts have equal fingerprints. Other
    columns are ignored; no rows give no rows.
    """
    versions = edited_documents(docs, doc_id, text)
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("pair"), F.col("digests").alias("first"), F.col(other).alias("second"))
            for k, other in enumerate(("edited_digests", "next_digests"))
        ]
    )
    found = differences(versions.select("row", F.explode(pairs).alias("p")).select("row", "p.*"))
    by_pair = [F.max(F.when(F.col("pair") == k, F.size("revealed"))).alias(f"found{k}") for k in (0, 1)]
    found = found.groupBy("row").agg(*by_pair)
    strings = published(versions, ["digests", "edited_digests"]).select(
        "row", F.col("digests").alias("fingerprint"), F.col("edited_digests").alias("edited_fingerprint")
    )
    return (
        versions.repartition("row")
        .join(strings, "row")
        .join(found, "row")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("digests"), F.col("edited_digests"), F.col("found0")).alias("near_edited"),
            likeness(F.col("digests"), F.col("next_digests"), F.col("found1")).alias("near_next"),
        )
    )

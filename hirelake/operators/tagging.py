"""A tagger of names in texts that is learnt from examples: a first-order hidden Markov model.

Tags are O (no name), B (first word of a name) and I (a further word); a sentence begins in state S. Only
words that the examples show inside names can be tagged B or I, all others are O. So a text falls apart
into short stretches of such words, each of which is decoded by itself, and a model is a row for each of
these words and twelve weights, whatever the number of texts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirelake.session import scratch_path

TAGS, BEFORE = ("O", "B", "I"), ("S", "O", "B", "I")  # at equal scores the first tag wins
# A word, with the signs after it up to one that ends its sentence, if there is one.
TOKEN = r"[\p{L}\p{N}_+#]+(?:[^\s\x1C-\x1F\x85\p{Z}\p{L}\p{N}_+#.!?]*[.!?])?"
TOKEN_WORD, ENDS = r"^[\p{L}\p{N}_+#]+", (".", "!", "?")
# Up to so many words are looked for inside the array of tokens, before rows are made; more are joined.
LOOKED_UP = 4096


def _ends(token: Column) -> Column:
    """Whether a sentence ends with a token; cheaper than an expression for each token of a text."""
    return reduce(or_, [F.contains(token, F.lit(sign)) for sign in ENDS])


def _known(words: DataFrame) -> list[str]:
    """The words, or more than LOOKED_UP of them."""
    return [r["word"] for r in words.select("word").limit(LOOKED_UP + 1).collect()]


def _tokens(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """A row per text with an id: id and its tokens in ``_raw``."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), tokens.alias("_raw"))


def _placed(known: Sequence[str]) -> Column:
    """The tokens whose lower-cased word is known, of the array ``_raw``: pos, word, first and goes_on.

    ``first`` tells that a sentence begins there, ``goes_on`` that another token of it follows. All tokens
    are placed if too many words are known to be looked for here.
    """

    def word(token: Column) -> Column:
        return F.lower(F.when(_ends(token), F.regexp_extract(token, TOKEN_WORD, 0)).otherwise(token))

    every = F.transform("_raw", lambda t, i: F.struct(i.alias("pos"), word(t).alias("word")))
    if len(known) <= LOOKED_UP:
        every = F.filter(every, lambda t: t["word"].isin(list(known))) if known else F.slice(every, 1, 0)
    return F.transform(
        every,
        lambda t: F.struct(
            t["pos"].alias("pos"),
            t["word"].alias("word"),
            ((t["pos"] == 0) | _ends(F.get("_raw", t["pos"] - 1))).alias("first"),
            ((t["pos"] + 1 < F.size("_raw")) & ~_ends(F.get("_raw", t["pos"]))).alias("goes_on"),
        ),
    )


def _with_words(found: DataFrame, words: DataFrame, known: Sequence[str]) -> DataFrame:
    """Tokens with the columns of their word; few words are sent to all tasks."""
    return found.join(F.broadcast(words) if len(known) <= LOOKED_UP else words, "word")


def _span_words(spans: DataFrame, id_col: str) -> DataFrame:
    """A row for each word of a span: id, pos, word, tag."""
    numbered = spans.where(F.col(id_col).isNotNull())
    words = numbered.select(F.col(id_col).alias("id"), "start", F.posexplode(F.split("term", " ")).alias("_k", "word"))
    tag = F.when(F.col("_k") == 0, "B").otherwise("I")
    return words.select("id", (F.col("start") + F.col("_k")).alias("pos"), "word", tag.alias("tag"))


class Tagger(NamedTuple):
    """A learnt tagger: a table (word, o, b, i) of log probabilities, and those of tag after tag."""

    words: DataFrame
    steps: dict[tuple[str, str], float]

    def save(self, path: str) -> None:
        """Writes the model as two small tables below ``path``, which must not exist."""
        self.words.write.parquet(f"{path}/words")
        rows = [(a, b, v) for (a, b), v in sorted(self.steps.items())]
        steps = self.words.sparkSession.createDataFrame(rows, "before string, tag string, weight double")
        steps.coalesce(1).write.parquet(f"{path}/steps")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Tagger:
        steps = spark.read.parquet(f"{path}/steps").collect()  # twelve rows
        return Tagger(spark.read.parquet(f"{path}/words"), {(r["before"], r["tag"]): r["weight"] for r in steps})

    def spans(self, docs: DataFrame, id_col: str, text: str) -> DataFrame:
        """The names that the most likely tags give: id, start (a word's number), n_words and term.

        A NULL or empty text has none. Terms are lower-cased words joined by blanks.
        """
        known = _known(self.words)
        # The array is made inside inline(): as a column it would be computed once more, by a filter for empty ones.
        seen = _with_words(_tokens(docs, id_col, text).select("id", F.inline(_placed(known))), self.words, known)
        by_place = W.partitionBy("id").orderBy("pos")
        begins = F.col("first") | F.coalesce(F.lag("pos").over(by_place) != F.col("pos") - 1, F.lit(True))
        parts = seen.withColumn("_part", F.sum(begins.cast("long")).over(by_place))
        members = F.struct("pos", "word", "first", "goes_on", F.array("o", "b", "i").alias("e"))
        stretches = parts.groupBy("id", "_part").agg(F.sort_array(F.collect_list(members)).alias("seen"))
        tagged = stretches.select("id", "seen", self._decoded(F.col("seen")).alias("tags"))
        opens = F.filter(
            F.sequence(F.lit(1), F.size("seen")),
            lambda k: (F.substring("tags", k, F.lit(1)) == "B")
            | ((F.substring("tags", k, F.lit(1)) == "I") & (F.when(k == 1, "O").otherwise(F.substring("tags", k - 1, F.lit(1))) == "O")),
        )
        length = lambda k: F.length(F.regexp_extract(F.substring("tags", k + 1, F.length("tags")), "^I*", 0)) + 1
        found = F.transform(
            opens,
            lambda k: F.struct(
                F.get("seen", k - 1)["pos"].alias("start"),
                length(k).alias("n_words"),
                F.array_join(F.transform(F.slice("seen", k, length(k)), lambda m: m["word"]), " ").alias("term"),
            ),
        )
        return tagged.select(F.col("id").alias(id_col), F.inline(found))

    def _decoded(self, seen: Column) -> Column:
        """The best tags of one stretch, a letter each: a fold that keeps the best way to each tag."""

        def way(score: Column, tags: Column) -> Column:
            return F.struct(score.alias("score"), tags.alias("tags"))

        def best(ways: list[Column]) -> Column:
            ranked = [F.struct(w["score"].alias("score"), F.lit(-k).alias("order"), w["tags"].alias("tags")) for k, w in enumerate(ways)]
            return F.array_max(F.array(*ranked))

        first = F.get(seen, F.lit(0))
        begun = F.array(
            *[
                way(F.when(first["first"], self.steps["S", t]).otherwise(self.steps["O", t]) + first["e"][k], F.lit(t))
                for k, t in enumerate(TAGS)
            ]
        )

        def step(ways: Column, token: Column) -> Column:
            reached = []
            for k, t in enumerate(TAGS):
                came = best([way(ways[j]["score"] + self.steps[p, t], ways[j]["tags"]) for j, p in enumerate(TAGS)])
                reached.append(way(came["score"] + token["e"][k], F.concat(came["tags"], F.lit(t))))
            return F.array(*reached)

        folded = F.reduce(F.slice(seen, 2, F.size(seen)), begun, step)
        ends = F.element_at(seen, -1)["goes_on"]
        # A token that follows in the sentence is O.
        return F.reduce(
            F.array(folded),
            F.lit(""),
            lambda _, ways: best(
                [way(ways[k]["score"] + F.when(ends, self.steps[t, "O"]).otherwise(0.0), ways[k]["tags"]) for k, t in enumerate(TAGS)]
            )["tags"],
        )


def fit_tagger(docs: DataFrame, spans: DataFrame, id_col: str, text: str) -> Tagger:
    """Learns from texts and the spans (id, start, n_words, term) of the names in them.

    Texts and spans without an id don't count. All counts are aggregates, one more than they are. Words are counted by tag, tags by
    the tag before them. What reaches the driver are thirteen sums. The spans and, unless they are too many, the tokens
    of the names' words are stored, so each text is read once for them.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "tagger")
    _span_words(spans, id_col).write.parquet(f"{path}/spans")
    named = spark.read.parquet(f"{path}/spans")
    named.groupBy("word").agg(*[F.count(F.when(F.col("tag") == t, 1)).alias(f"n{t}") for t in "BI"]).write.parquet(f"{path}/named")
    words = spark.read.parquet(f"{path}/named")
    known = _known(words)
    raw = _tokens(docs, id_col, text)
    size = F.size("_raw")
    ended = F.size(F.filter(F.slice("_raw", 1, F.greatest(size - 1, F.lit(0))), _ends))
    texts = raw.select("id", size.alias("n_tokens"), (F.least(size, F.lit(1)) + ended).alias("n_first"), _placed(known).alias("placed"))
    found = raw.select("id", F.inline(_placed(known)))
    if len(known) <= LOOKED_UP:
        texts.write.parquet(f"{path}/texts")
        texts = spark.read.parquet(f"{path}/texts")
        found = texts.select("id", F.inline("placed"))
    seen = _with_words(found, words.select("word"), known).join(named.select("id", "pos", "tag"), ["id", "pos"], "left")
    by_place = W.partitionBy("id").orderBy("pos")
    adjacent = F.lag("pos").over(by_place) == F.col("pos") - 1
    tagged = seen.withColumn("tag", F.coalesce("tag", F.lit("O"))).select(
        "word",
        "tag",
        "first",
        F.when(F.col("first"), "S").when(adjacent, F.lag("tag").over(by_place)).otherwise("O").alias("before"),
        (F.col("goes_on") & F.coalesce(F.lead("pos").over(by_place) != F.col("pos") + 1, F.lit(True))).alias("left"),
    )
    tagged.groupBy("word", "tag", "before", "first", "left").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    steps = {(r["before"], r["tag"]): r["n"] for r in counts.groupBy("before", "tag").agg(F.sum("n").alias("n")).collect()}
    leaving = {r["tag"]: r["n"] for r in counts.where("left").groupBy("tag").agg(F.sum("n").alias("n")).collect()}
    sizes = texts.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_first").alias("first")).first()
    tokens, first = sizes["tokens"] or 0, sizes["first"] or 0
    # All other tokens are O: those after a sentence's begin, after a word that names have, after another.
    seen_first = sum(n for (before, _), n in steps.items() if before == "S")
    seen_later = sum(steps.values()) - seen_first
    for tag, n in leaving.items():
        steps[tag, "O"] = steps.get((tag, "O"), 0) + n
    steps["S", "O"] = steps.get(("S", "O"), 0) + first - seen_first
    steps["O", "O"] = steps.get(("O", "O"), 0) + tokens - first - seen_later - sum(leaving.values())
    sums = words.agg(F.count(F.lit(1)).alias("words"), F.sum("nB").alias("B"), F.sum("nI").alias("I")).first()
    totals = {"B": sums["B"] or 0, "I": sums["I"] or 0}
    totals["O"] = tokens - totals["B"] - totals["I"]
    outside = counts.where("tag = 'O'").groupBy("word").agg(F.sum("n").alias("nO"))
    weights = [
        F.log((F.coalesce(f"n{t}", F.lit(0)) + 1) / (totals[t] + sums["words"] + 1)).alias(t.lower()) for t in TAGS
    ]
    words.join(outside, "word", "left").select("word", *weights).write.parquet(f"{path}/words")
    after = {b: sum(steps.get((b, t), 0) for t in TAGS) + len(TAGS) for b in BEFORE}
    logs = {(b, t): math.log((steps.get((b, t), 0) + 1) / after[b]) for b in BEFORE for t in TAGS}
    return Tagger(spark.read.parquet(f"{path}/words"), logs)

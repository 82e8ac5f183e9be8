"""The registered queries of the operators: name -> (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import (
    bpe, chat, mixing, packing, periodic, quality, simhash, sketches, token_files, toxicity, vectors, warc, whitening,
)
from hirelake.llm.common import WORD, read_table, remainder
from hirelake.llm.tokens import vocabulary
from hirelake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark, folder):
    """All documents mixed to the weights 3, 1, 2 of their sources."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_simhash_near_dedup(spark, folder):
    """Fingerprints of four-word shingles of all documents, and the groups they link."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicate_groups(docs, width=4, keep_text=False).select(
        "doc_id", "fingerprint", "component_id"
    )


@query
def op4_pack_windows(spark, folder):
    """All documents in sequences of 4,096 tokens."""
    pieces = packing.pack(read_table(spark, folder, "documents"))
    return pieces.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op5_token_files(spark, folder):
    """All documents written as token files, and read back from them."""
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(read_table(spark, folder, "documents"), path)
    rows = token_files.with_checksums(token_files.read_tokens(spark, path))
    return rows.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")


def held_out(parts: int, which: int):
    """Whether a document's number keeps its label from the training; without a number it has none."""
    return F.coalesce(remainder("doc_id", parts) == which, F.lit(False))


@query
def op6_quality_classifier(spark, folder):
    """Quality of all documents, learnt from four fifths of the labelled ones."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").where(~held_out(5, 0))
    scored = quality.with_quality(docs, *quality.train(docs, labels), keep_text=False)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query
def op8_toxicity(spark, folder):
    """Toxicity of all documents, learnt from three quarters of the labelled ones."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").where(~held_out(4, 2))
    model = toxicity.train(docs, labels, usable=~held_out(4, 2))
    scored = toxicity.with_toxicity(docs, model, keep_text=False)
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


@query
def op10_embedding_near_dedup(spark, folder):
    """Links and groups of all vectors with a cosine of 0.9 or more."""
    return vectors.near_duplicate_vectors(read_table(spark, folder, "embeddings"))


@query
def op7_lookup_sketch(spark, folder):
    """Sketches of all documents and their edited texts, compared."""
    return sketches.compared_fingerprints(read_table(spark, folder, "documents"))


@query
def op3_perspective_rotation(spark, folder):
    """All conversations, rendered for each of their participants."""
    rendered = chat.rotated(read_table(spark, folder, "conversations"))
    return rendered.select("conv_id", "assistant", "block", "n_messages", "text", chat.mask_text("spans").alias("mask"))


@query
def op9_warc_derivatives(spark, folder):
    """Metadata and conversion records of the responses that all pages were."""
    records = warc.derive(warc.responses(read_table(spark, folder, "pages")))
    return records.withColumn("source_headers", F.array_join("source_headers", "\n"))


@query
def op11_bpe_round_trip(spark, folder):
    """Token ids of all documents by prefix-wise encoding, and the texts decoded from them."""
    path = vocabulary("byte_bpe_50k.json")
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    rows = bpe.decoded(bpe.encoded(docs, path, keep_text=False), path)
    return rows.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_embedding_whitening(spark, folder):
    """All usable vectors along the first sixteen components of their covariance, each of variance 1."""
    rows, model = whitening.whitened(read_table(spark, folder, "embeddings").select("vec_id", "embedding"))
    explained = F.array(*[F.lit(float(v) / model.trace) for v in model.values]).cast("array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def with_planted_periods(docs):
    """Documents whose number's checksum ends in 0 repeat a stretch of their words to their end."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    some = docs.withColumn("g", F.floor(checksum / 10)).withColumn(
        "words", F.when(checksum % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})")))
    )
    n = F.size("words").cast("long")
    first = F.expr("g % size(words)")
    period = F.expr("1 + floor((size(words) - g % size(words)) / (3 + g % 8))")
    placed = some.withColumn("a", F.when(n > 0, first)).withColumn("p", F.when(n > 0, period))
    repeated = F.expr(
        "array_join(transform(sequence(0, size(words) - 1),"
        " i -> words[CAST(IF(i < a, i, a + (i - a) % p) AS INT)]), ' ')"
    )
    return placed.withColumn("text", F.when(n > 0, repeated).otherwise(F.col("text"))).drop("g", "words", "a", "p")


@query
def op13_periodic_runs(spark, folder):
    """Periodic runs of words of all documents, some of which get planted periods."""
    docs = with_planted_periods(read_table(spark, folder, "documents").select("doc_id", "text"))
    rows = periodic.with_runs(docs, keep_text=False)
    # The greatest exact length / period; ties go to the smallest start, then period, the first in the list.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

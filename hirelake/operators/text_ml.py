"""The title classifier and the scores of classifiers and taggers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.scoring import hash_bucket

DEV_BUCKET, BUCKETS = 0, 5


def hash_split(df: DataFrame, id_col: str) -> DataFrame:
    """Rows with their bucket (0 to 4) and split: bucket 0 is 'dev', the others are 'train'."""
    bucket = hash_bucket(F.col(id_col), BUCKETS)
    split = F.when(F.col("bucket") == DEV_BUCKET, "dev").otherwise("train")
    return df.withColumn("bucket", bucket).withColumn("split", split)


WORD = r"[\p{L}\p{N}_]+"


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


class NaiveBayes(NamedTuple):
    """A fitted multinomial classifier: word weights per label, and each label's prior and cost per word."""

    weights: DataFrame  # word and one column per label
    labels: list[str]
    priors: list[float]
    costs: list[float]

    def predict(self, rows: DataFrame, id_col: str, text: str, name: str = "predicted") -> DataFrame:
        """Rows with their best label; equal scores go to the first label by code point.

        Words that the training has not seen don't count. ``id_col`` tells rows apart. The words of a
        text are counted before they meet their weights.
        """
        counted = rows.select(id_col, F.explode(_words(text)).alias("word")).groupBy(id_col, "word").agg(
            F.count(F.lit(1)).alias("_n")
        )
        sums = [F.sum(F.col("_n") * F.col(f"w{k}")).alias(f"s{k}") for k in range(len(self.labels))]
        scored = counted.join(self.weights, "word").groupBy(id_col).agg(F.sum("_n").alias("_known"), *sums)
        zero = F.lit(0)
        ranked = F.array(
            *[
                F.struct(
                    F.round(
                        F.lit(self.priors[k]) - F.coalesce("_known", zero) * F.lit(self.costs[k]) + F.coalesce(f"s{k}", F.lit(0.0)), 6
                    ).alias("score"),
                    F.lit(-k).alias("order"),
                    F.lit(label).alias("label"),
                )
                for k, label in enumerate(self.labels)
            ]
        )
        return rows.join(scored, id_col, "left").select(*rows.columns, F.array_max(ranked)["label"].alias(name))

    def save(self, path: str) -> None:
        """Writes the words' weights and, in a row per label, priors and costs, below ``path``."""
        self.weights.write.parquet(f"{path}/weights")
        rows = list(zip(range(len(self.labels)), self.labels, self.priors, self.costs))
        labels = self.weights.sparkSession.createDataFrame(rows, "place int, label string, prior double, cost double")
        labels.coalesce(1).write.parquet(f"{path}/labels")

    @staticmethod
    def load(spark: SparkSession, path: str) -> NaiveBayes:
        """A model that ``save`` has written; it predicts what the saved one does."""
        rows = spark.read.parquet(f"{path}/labels").orderBy("place").collect()  # a row per label
        columns = [[r[c] for r in rows] for c in ("label", "prior", "cost")]
        return NaiveBayes(spark.read.parquet(f"{path}/weights"), *columns)


def fit_naive_bayes(train: DataFrame, text: str, label: str) -> NaiveBayes:
    """Counts words per label and labels; every count is one more than it is.

    Two aggregates over the texts, and results as large as the vocabulary times the labels, of which
    there are few. Rows without a label don't count.
    """
    labelled = train.where(F.col(label).isNotNull())
    counts = labelled.select(F.col(label).alias("label"), F.explode(_words(text)).alias("word")).groupBy("label", "word").agg(
        F.count(F.lit(1)).alias("n")
    )
    documents = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}
    if not documents:
        raise ValueError("no row has a label")
    totals = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    labels = sorted(documents)
    columns = [F.max(F.when(F.col("label") == name, F.log(F.col("n") + 1))) for name in labels]
    weights = counts.groupBy("word").agg(
        *[F.coalesce(c, F.lit(0.0)).alias(f"w{k}") for k, c in enumerate(columns)]
    )
    vocabulary = weights.count()
    everyone = sum(documents.values()) + len(labels)
    return NaiveBayes(
        weights,
        labels,
        [math.log((documents[name] + 1) / everyone) for name in labels],
        [math.log(totals.get(name, 0) + max(vocabulary, 1)) for name in labels],
    )


def train_text_classifier(
    train: DataFrame, text: str, label: str, features: int = 1 << 14
) -> PipelineModel:
    """A bag-of-words classifier by multinomial regression: slower to fit than ``fit_naive_bayes``.

    Its size depends on the number of hashed features and classes, not on the data.
    """
    prepare = Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="_label"),
            RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}_]+", toLowercase=True),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
        ]
    ).fit(train)
    counts = prepare.transform(train).select("_label", "_counts").persist()
    regression = LogisticRegression(
        featuresCol="_counts", labelCol="_label", family="multinomial", maxIter=20, regParam=0.01
    ).fit(counts)
    counts.unpersist()
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=prepare.stages[0].labels)
    return PipelineModel(stages=[*prepare.stages, regression, names])


def macro_f1(scored: DataFrame, gold: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """Precision, recall and F per label, and their means in the row 'macro'.

    Pairs of gold and predicted label are counted first; everything after sees at most the square
    of the number of labels.
    """
    pairs = scored.groupBy(F.col(gold).alias("gold"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counted = (
        pairs.withColumn("label", F.explode(F.array(*[F.lit(x) for x in labels])))
        .groupBy("label")
        .agg(
            *[
                F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name)
                for name, condition in (
                    ("tp", (F.col("gold") == F.col("label")) & F.col("predicted").eqNullSafe(F.col("label"))),
                    ("fp", ~F.col("gold").eqNullSafe(F.col("label")) & (F.col("predicted") == F.col("label"))),
                    ("fn", (F.col("gold") == F.col("label")) & ~F.col("predicted").eqNullSafe(F.col("label"))),
                )
            ]
        )
    )
    scores = with_prf(counted)
    macro = scores.agg(
        F.lit("macro").alias("label"),
        *[F.sum(n).alias(n) for n in ("tp", "fp", "fn")],
        *[F.round(F.avg(n), 6).alias(n) for n in ("precision", "recall", "f1")],
    )
    return scores.unionByName(macro)


def with_prf(counted: DataFrame) -> DataFrame:
    """Precision, recall and F from true positives, false positives and false negatives."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def share(part, whole):
        return F.round(F.when(whole > 0, part / whole).otherwise(F.lit(0.0)), 6)

    return counted.withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
    )


def entity_prf(gold: DataFrame, predicted: DataFrame, id_col: str) -> DataFrame:
    """Scores of predicted spans (id, start, n_words, term) per term, and of all in the row 'ALL'.

    A span counts as found when text, start and length agree.
    """
    on = [id_col, "start", "n_words", "term"]
    marked = gold.select(*on, F.lit(1).alias("in_gold")).join(
        predicted.select(*on, F.lit(1).alias("in_predicted")), on, "full_outer"
    )
    in_gold, in_predicted = F.col("in_gold").isNotNull(), F.col("in_predicted").isNotNull()
    per_term = marked.groupBy("term").agg(
        F.count(F.when(in_gold & in_predicted, 1)).alias("tp"),
        F.count(F.when(~in_gold, 1)).alias("fp"),
        F.count(F.when(~in_predicted, 1)).alias("fn"),
    )
    summed = per_term.rollup("term").agg(
        F.grouping("term").alias("_all"), *[F.sum(n).alias(n) for n in ("tp", "fp", "fn")]
    )
    named = summed.select(
        F.when(F.col("_all") == 1, "ALL").otherwise(F.col("term")).alias("term"), "tp", "fp", "fn"
    )
    return with_prf(named)


# What the F of the entities and the F of the categories weigh in the training score.
ENTITY_WEIGHT, CATEGORY_WEIGHT = 0.5, 0.5


def training_score(entities: DataFrame, categories: DataFrame) -> DataFrame:
    """One number from the 'ALL' row of ``entity_prf`` and the 'macro' row of ``macro_f1``."""
    parts = entities.where("term = 'ALL'").select((F.col("f1") * ENTITY_WEIGHT).alias("part"))
    parts = parts.unionByName(
        categories.where("label = 'macro'").select((F.col("f1") * CATEGORY_WEIGHT).alias("part"))
    )
    # Halves of six digits have seven: nothing is rounded once more, and the sum is that of decimals.
    return parts.agg(F.sum(F.col("part").cast("decimal(18,7)")).cast("double").alias("score"))

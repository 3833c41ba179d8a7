"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features are those of `toxic_features`. Trees are fitted on four fifths of the labelled
rows that may be learnt from, the calibration on the rest.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import free_name
from meterstar.llm.toxic_features import learn_stems, with_features
from meterstar.scratch import staged


def fold(id_column: str, of: int) -> Column:
    return F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(of))


class Model:
    """Boosted trees and their calibration; or, without labels of both kinds, a constant."""

    def __init__(self, constant: float, trees=None, calibration=None) -> None:
        self.constant, self.trees, self.calibration = constant, trees, calibration

    @classmethod
    def fit(cls, labelled: DataFrame, iterations: int = 30, depth: int = 3) -> Model:
        """From rows (id, features array<double>, label 0 or 1)."""
        n, positive = labelled.agg(F.count("label"), F.sum("label")).first()
        if not positive or positive == n:
            return cls(float(positive or 0) / n if n else 0.0)
        rows = labelled.select(
            array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"),
            (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).alias("later"),
        )
        trees = GBTClassifier(
            maxIter=iterations, maxDepth=depth, stepSize=0.2, maxBins=64, seed=7,
            minInstancesPerNode=5, cacheNodeIds=False,
        )
        if not rows.filter("later").select("label").distinct().count() == 2 or \
                not rows.filter("not later").select("label").distinct().count() == 2:
            return cls(0.0, trees.fit(rows.drop("later")))
        fitted = trees.fit(rows.filter("not later").drop("later"))
        raw = fitted.transform(rows.filter("later").select("features", "label")).select(
            vector_to_array("probability")[1].alias("raw"), "label"
        )
        calibration = IsotonicRegression(featuresCol="raw", predictionCol="score").fit(raw)
        return cls(0.0, fitted, calibration)

    def scored(self, df: DataFrame, features_column: str, name: str) -> DataFrame:
        """`df` with the column `name`, from 0 to 1."""
        if self.trees is None:
            return df.withColumn(name, F.lit(self.constant))
        vector, raw = (free_name(df, x) for x in ("_vector", "_raw"))
        made = [free_name(df, x) for x in ("_margin", "_probability", "_prediction")]
        trees = self.trees.copy().setFeaturesCol(vector).setRawPredictionCol(made[0])
        trees = trees.setProbabilityCol(made[1]).setPredictionCol(made[2])
        out = trees.transform(df.withColumn(vector, array_to_vector(features_column)))
        out = out.withColumn(raw, vector_to_array(made[1])[1])
        if self.calibration is None:
            out = out.withColumn(name, F.col(raw))
        else:
            out = self.calibration.copy().setFeaturesCol(raw).setPredictionCol(name).transform(out)
        return out.drop(vector, raw, *made)


def score_documents(docs: DataFrame, labels: DataFrame, text_column: str = "text",
                    id_column: str = "doc_id", label_column: str = "toxic",
                    learn_from: Column | None = None, score_column: str = "score",
                    keep_text: bool = True) -> DataFrame:
    """`docs` with `score`, the probability of label 1.

    `labels` has the id and a label 0 or 1; it is joined by id to learn, filtered by
    `learn_from` (a condition on the id), and never a feature. Rows without label are not
    learnt from, nor are null ids. Without labels of both kinds the score is their mean (0
    without any). Null and empty texts are scored by all-zero features. Ids may repeat;
    other columns are kept and not looked at. An empty table gives no rows. If `docs` has a
    column of the score's name, the new one gets underscores before its own.
    """
    score_column = free_name(docs, score_column)
    name = free_name(docs, "_features")
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    wanted = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"))
    wanted = wanted.filter("id is not null and label in (0, 1)")
    if learn_from is not None:
        wanted = wanted.filter(learn_from)
    table = with_features(docs, text_column, name, learn_stems(plain, wanted))
    table = staged(table if keep_text else table.drop(text_column), "features")
    # Training reads its rows many times: once written, they are small.
    labelled = staged(
        table.select(F.col(id_column).alias("id"), F.col(name).alias("features")).join(wanted, "id"),
        "labelled",
    )
    return Model.fit(labelled).scored(table, name, score_column).drop(name)


def clean_documents(docs: DataFrame, labels: DataFrame, limit: float = 0.5,
                    text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of `docs` scored below `limit`, in its columns."""
    score = free_name(docs, "_score")
    scored = score_documents(docs, labels, text_column, id_column, score_column=score)
    return scored.filter(F.col(score) < limit).select(*docs.columns)

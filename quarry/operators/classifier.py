"""Model-based quality filter with ``pyspark.ml``.

Hashed term frequencies with IDF weights and a logistic regression are
trained on the labelled documents and score the whole corpus. Features are
computed per row and the model is fit by distributed gradient descent, so
nothing is collected to the driver except model coefficients.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.calibration import auc
from quarry.session import checkpointed


def quality_pipeline(num_features: int = 1 << 18, reg: float = 0.01, max_iter: int = 50) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="_tokens", pattern=r"[^\p{L}\p{N}]+",
                       toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="_label", regParam=reg,
                           maxIter=max_iter, probabilityCol="_prob"),
    ])


def quality_classifier(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                       label_col: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, p_quality, kept`` for every document: train on the labelled
    subset (inner join on id, all rows with a label), score all, keep ``p >= threshold``."""
    corpus = docs.select(id_col, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    train = corpus.join(labels.select(id_col, F.col(label_col).cast("double").alias("_label")).dropna(), id_col)
    model = quality_pipeline().fit(train)
    scored = model.transform(corpus)
    p = F.round(vector_to_array(F.col("_prob"))[1], 6)
    return scored.select(id_col, p.alias("p_quality"), (p >= threshold).alias("kept"))


def quality_holdout(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 5,
                    label_col: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """``n, auc, tp, fp, tn, fn`` on the labelled documents whose hashed id
    falls into the first of ``folds`` folds; the model is trained on the
    others."""
    fold = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(folds))
    marked = labels.select(id_col, F.col(label_col).cast("double").alias("_label")).dropna()
    rows = docs.select(id_col, F.coalesce(F.col("text"), F.lit("")).alias("text")).join(marked, id_col)
    scored = quality_pipeline().fit(rows.filter(fold != 0)).transform(rows.filter(fold == 0))
    p = vector_to_array(F.col("_prob"))[1]
    flat = checkpointed(scored.select("_label", p.alias("_p"), (p >= threshold).alias("_yes")))  # the model scores once
    area = auc(flat, "_p", "_label").select(F.round("auc", 6).alias("auc"))
    good, yes = F.col("_label") == 1, F.col("_yes")
    cells = flat.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(name) for name, c in (
        ("tp", good & yes), ("fp", ~good & yes), ("tn", ~good & ~yes), ("fn", good & ~yes))])
    return cells.join(F.broadcast(area))  # single rows

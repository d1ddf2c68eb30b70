"""How well a score separates good documents from bad ones, and what it is worth as a probability.

The area under the curve is a rank statistic: of two documents with different
labels, how often the good one scores higher, ties counting half. Rows are
first summed by score, then the negatives below each score are a prefix sum
over range partitions, so no task sees all scores. Calibration fits the
monotone step function that is nearest to the labels (isotonic regression of
``pyspark.ml``, on the sums by score) and reads it off by interpolation.
"""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.plans.ordering import range_prefix


def _sums(scored: DataFrame, score: str, label: str) -> DataFrame:
    """``score, pos, neg`` by distinct score; rows without a score (NULL, NaN) or a label of 0 or 1 take no part."""
    flat = scored.select(F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label"))
    flat = flat.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isin(0.0, 1.0))
    return flat.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))


def auc(scored: DataFrame, score: str = "score", label: str = "label", n_parts: int | None = None) -> DataFrame:
    """One row ``n_pos, n_neg, auc``; NULL where a label is missing altogether."""
    ranked = range_prefix(_sums(scored, score, label), ["score"], {"under": F.col("neg")}, n_parts)
    # Twice the pairs won, an integer, so the sum does not depend on its order.
    won = F.sum(F.col("pos").cast("decimal(38,0)") * (F.lit(2) * F.col("under") + F.col("neg")).cast("decimal(20,0)"))
    sums = ranked.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"), won.alias("_won"))
    area = F.try_divide(F.col("_won").cast("double"), F.lit(2.0) * F.col("n_pos") * F.col("n_neg"))
    return sums.select("n_pos", "n_neg", area.alias("auc"))


def confusion(scored: DataFrame, thresholds: list[float], score: str = "score", label: str = "label") -> DataFrame:
    """``threshold, tp, fp, tn, fn`` where rows of ``threshold`` or more count as good: one aggregation."""
    sums = _sums(scored, score, label)
    each = sums.withColumn("threshold", F.explode(F.lit([float(t) for t in thresholds])))
    yes = F.col("score") >= F.col("threshold")
    cell = lambda what, when, name: F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long").alias(name)
    return each.groupBy("threshold").agg(cell("pos", yes, "tp"), cell("neg", yes, "fp"), cell("neg", ~yes, "tn"), cell("pos", ~yes, "fn"))


def calibrate(scored: DataFrame, score: str = "score", label: str = "label") -> IsotonicRegressionModel:
    """The monotone function of the score that is nearest to the labels."""
    sums = _sums(scored, score, label).select("score", (F.col("pos") / (F.col("pos") + F.col("neg"))).alias("share"), (F.col("pos") + F.col("neg")).cast("double").alias("weight"))
    return IsotonicRegression(featuresCol="score", labelCol="share", weightCol="weight").fit(sums)


def calibrated(df: DataFrame, model: IsotonicRegressionModel, score: str = "score", out: str = "probability") -> DataFrame:
    """``df`` with the probability that the model gives each score: linear between its steps, constant beyond; a missing score stays NULL.

    The steps are arrays in the plan, searched by a built-in, so rows need no Python."""
    xs, ys = [float(x) for x in model.boundaries.toArray()], [float(y) for y in model.predictions.toArray()]
    if not xs:
        return df.withColumn(out, F.lit(None).cast("double"))
    x, bounds, values = F.col(score).cast("double"), F.lit(xs), F.lit(ys)
    above = F.size(F.filter(bounds, lambda b: b <= x)) if len(xs) < 64 else _upper(bounds, x, len(xs))
    left, right = F.get(bounds, above - 1), F.get(bounds, above)
    low, high = F.get(values, above - 1), F.get(values, above)
    inner = low + (high - low) * (x - left) / (right - left)
    value = F.when(x.isNull() | F.isnan(x), F.lit(None).cast("double")).when(above == 0, F.lit(ys[0])).when(above == len(xs), F.lit(ys[-1])).otherwise(inner)
    return df.withColumn(out, value)


def _upper(bounds: Column, x: Column, n: int) -> Column:
    """How many of the ascending ``bounds`` are at most ``x``: halving steps over the array."""
    steps, width = [], 1
    while width <= n:
        steps.append(width)
        width *= 2
    at = F.lit(0)
    return F.aggregate(F.lit(steps[::-1]), at, lambda place, step: F.when(F.get(bounds, place + step - 1) <= x, place + step).otherwise(place))


def reliability(scored: DataFrame, probability: str, label: str = "label", bins: int = 10) -> DataFrame:
    """``bin, n, mean_probability, share_good``: in a calibrated score the last two agree."""
    p = F.col(probability).cast("double")
    rows = scored.filter(p.isNotNull() & F.col(label).isNotNull()).withColumn("bin", F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int"))
    return rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_probability"), F.avg(F.col(label).cast("double")).alias("share_good"))

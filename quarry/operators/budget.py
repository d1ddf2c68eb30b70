"""Token-budget planning from compute-optimal scaling.

Compute-optimal sizes for a FLOP budget ``C``: ``N = 0.079 * sqrt(C)``
parameters and ``D = 2.1 * sqrt(C)`` tokens; predicted loss
``A / N^alpha + B / D^beta + L0``. The data-dependent part is the token
count per source, a partial/final aggregation over the tokenised corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Loss-law constants of the scaling-law step.
LOSS_A = 406.4
LOSS_B = 410.7
LOSS_ALPHA = 0.34
LOSS_BETA = 0.28
LOSS_L0 = 1.69
# Compute-optimal coefficients.
N_PER_SQRT_C = 0.079
D_PER_SQRT_C = 2.1


def optimal_sizes(flops: float) -> tuple[float, float]:
    root = math.sqrt(flops)
    return N_PER_SQRT_C * root, D_PER_SQRT_C * root


def predicted_loss(n_params: float, n_tokens: float) -> float:
    return LOSS_A / n_params ** LOSS_ALPHA + LOSS_B / n_tokens ** LOSS_BETA + LOSS_L0


def token_budget(tokens: DataFrame, shares: dict[str, float], flops: float = 1e21,
                 source_col: str = "source", n_tokens: str = "n_tokens") -> DataFrame:
    """Per source: available tokens, target tokens (``D * share``), epochs
    needed, and the loss predicted for the optimal model trained on the
    available tokens."""
    n_opt, d_opt = optimal_sizes(flops)
    share = F.lit(None).cast("double")
    for s, p in shares.items():
        share = F.when(F.col(source_col) == s, F.lit(float(p))).otherwise(share)
    avail = tokens.groupBy(source_col).agg(F.sum(n_tokens).cast("long").alias("tokens"))
    target = F.lit(d_opt) * share
    loss = (F.lit(LOSS_A / n_opt ** LOSS_ALPHA)
            + F.lit(LOSS_B) / F.pow(F.col("tokens").cast("double"), F.lit(LOSS_BETA)) + F.lit(LOSS_L0))
    return avail.select(source_col, "tokens",
                        F.round(target, 3).alias("target_tokens"),
                        F.round(target / F.col("tokens"), 6).alias("epochs"),
                        F.round(loss, 6).alias("loss"))

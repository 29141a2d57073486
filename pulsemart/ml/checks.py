"""What must hold for the outputs of any trained model, as tables that plain SQL can state too.

The values of a model depend on its learner; the rows it covers, the columns it carries,
its totals and its consistency do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsemart.config import HealthConfig
from pulsemart.ml.training import KEEP


def _share(c: str) -> Column:
    return F.coalesce(F.col(c).between(0, 1), F.lit(False))


def checked_predictions(predictions: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Every tenant's carried columns; the flag agrees with the probability but for its rounding."""
    probability, threshold = F.col("churn_probability"), cfg.churn_threshold
    agrees = (F.col("churn_flag") == (probability >= threshold).cast("int")) | (F.abs(probability - threshold) <= 5e-5)
    return predictions.select(*KEEP, _share("churn_probability").alias("in_range"), agrees.alias("flag_agrees"))


def checked_importance(importance: DataFrame) -> DataFrame:
    """A row per feature; shares add up to 1. The window runs over the features of the model."""
    total = F.round(F.sum("importance").over(W.partitionBy()), 6)
    return importance.select("feature", _share("importance").alias("in_range"), total.alias("total"))


def checked_ranking(top: DataFrame) -> DataFrame:
    """Places in the order given, and whether each is at most as important as the one before."""
    order = W.orderBy(F.col("importance").desc(), "feature")
    falls = F.col("importance") <= F.coalesce(F.lag("importance").over(order), F.lit(1.0))
    return top.select(F.row_number().over(order).alias("place"), falls.alias("falls"))


def checked_metrics(metrics: DataFrame) -> DataFrame:
    """The four cells add up to the tenants of each class, the two sums of money to all churned money."""
    money = [F.col(c).cast("decimal(28,6)") for c in ("arr_correctly_flagged", "arr_missed")]
    return metrics.select(
        "model",
        "decision_threshold",
        (F.col("true_positives") + F.col("false_negatives")).alias("churned"),
        (F.col("true_negatives") + F.col("false_positives")).alias("active"),
        (money[0] + money[1]).cast("double").alias("churned_arr"),
        (_share("cv_roc_auc_mean") & _share("cv_avg_precision_mean")).alias("in_range"),
    )


def checked_summary(summary: DataFrame) -> DataFrame:
    shares = _share("cv_roc_auc_mean") & _share("cv_roc_auc_std") & _share("cv_avg_precision_mean")
    return summary.select("decision_threshold", shares.alias("in_range"))


def checked_validation(validation: DataFrame) -> DataFrame:
    """One row per figure."""
    shares = F.array(*[F.struct(F.lit(c).alias("figure"), _share(c).alias("in_range")) for c in validation.columns])
    return validation.select(F.inline(shares))


def checked_leak(leaky: DataFrame, validation: DataFrame) -> DataFrame:
    """The stage gives the outcome away: with it the area must be above that without."""
    leak, clean = leaky.first()[0], validation.first().cv_roc_auc_mean
    return leaky.sparkSession.createDataFrame([(leak > clean, 0 <= leak <= 1)], "leak_shows BOOLEAN, in_range BOOLEAN")

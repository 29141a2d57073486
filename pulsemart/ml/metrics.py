"""Evaluation of a score against a label, as aggregations.

Input columns: ``label`` 0/1, ``score``, and ``arr`` where money is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.functions import money_sum
from pulsemart.operators.ranking import running_totals


def class_balance(scored: DataFrame) -> DataFrame:
    positive, negative = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    return scored.agg(
        F.count("*").alias("n"),
        positive.alias("positives"),
        F.avg(F.col("label").cast("double")).alias("churn_rate"),
        F.try_divide(negative, positive).alias("scale_pos_weight"),
    )


def _outcome(predicted: int, actual: int, threshold: float) -> Column:
    flagged = (F.col("score") >= threshold).cast("int")
    return (flagged == predicted) & (F.col("label") == actual)


def _outcome_counts(threshold: float) -> list[Column]:
    names = {"tn": (0, 0), "fp": (1, 0), "fn": (0, 1), "tp": (1, 1)}
    return [F.count_if(_outcome(*pair, threshold)).alias(name) for name, pair in names.items()]


def confusion_matrix(scored: DataFrame, threshold: float = 0.35) -> DataFrame:
    return scored.agg(*_outcome_counts(threshold))


def _outcome_money(threshold: float) -> list[Column]:
    def money(predicted: int) -> Column:
        return money_sum(F.when(_outcome(predicted, 1, threshold), F.col("arr")))

    return [money(1).alias("arr_correctly_flagged"), money(0).alias("arr_missed")]


def arr_by_outcome(scored: DataFrame, threshold: float = 0.35) -> DataFrame:
    return scored.agg(*_outcome_money(threshold))


def outcome_summary(scored: DataFrame, threshold: float = 0.35) -> DataFrame:
    """Confusion matrix and money in one aggregation."""
    return scored.agg(*_outcome_counts(threshold), *_outcome_money(threshold))


def classification_report(scored: DataFrame, threshold: float = 0.35) -> DataFrame:
    """Two classes, accuracy and both averages; undefined ratios count as 0."""
    counts = scored.agg(*_outcome_counts(threshold))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def one_class(hit: str, wrongly_in: str, missed: str, prefix: str) -> dict[str, Column]:
        hits, extra, lost = F.col(hit), F.col(wrongly_in), F.col(missed)
        return {
            f"{prefix}_precision": ratio(hits, hits + extra),
            f"{prefix}_recall": ratio(hits, hits + lost),
            f"{prefix}_f1": ratio(2 * hits, 2 * hits + extra + lost),
            f"{prefix}_support": hits + lost,
        }

    measured = counts.withColumns(
        {**one_class("tn", "fn", "fp", "active"), **one_class("tp", "fp", "fn", "churned")}
    )
    support = F.col("active_support") + F.col("churned_support")
    measures = ("precision", "recall", "f1")

    def line(name: str, values: list[Column], rows: Column) -> Column:
        named = [v.cast("double").alias(m) for m, v in zip(measures, values)]
        return F.struct(F.lit(name).alias("name"), *named, rows.alias("support"))

    lines = [
        line(cls.title(), [F.col(f"{cls}_{m}") for m in measures], F.col(f"{cls}_support"))
        for cls in ("active", "churned")
    ]
    accuracy = ratio(F.col("tn") + F.col("tp"), support)
    lines.append(line("accuracy", [F.lit(None), F.lit(None), accuracy], support))
    macro = [(F.col(f"active_{m}") + F.col(f"churned_{m}")) / 2 for m in measures]
    lines.append(line("macro avg", macro, support))
    weighted = [
        ratio(
            F.col(f"active_{m}") * F.col("active_support") + F.col(f"churned_{m}") * F.col("churned_support"),
            support,
        )
        for m in measures
    ]
    lines.append(line("weighted avg", weighted, support))
    return measured.select(F.inline(F.array(*lines)))


def _per_score(scored: DataFrame) -> DataFrame:
    """One row per distinct score, which also folds all ties into one row."""
    return (
        scored.where(F.col("score").isNotNull())
        .groupBy("score")
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") == 0).alias("neg"),
        )
    )


def threshold_counts(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per distinct score: rows of each class at it (``pos``, ``neg``), at or above it
    (``cum_*``) and altogether (``all_*``).

    Nothing runs before the result is asked for.
    """
    return running_totals(_per_score(scored), "score", ["pos", "neg"], ranges)


def roc_curve(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    """A point per distinct score plus the origin, whose threshold is infinite."""
    points = threshold_counts(scored, ranges).select(
        F.col("score").alias("threshold"),
        F.try_divide("cum_neg", "all_neg").alias("fpr"),
        F.try_divide("cum_pos", "all_pos").alias("tpr"),
    )
    origin = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin).orderBy(F.col("threshold").desc())


def pr_curve(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    """A point per distinct score plus (recall 0, precision 1)."""
    points = threshold_counts(scored, ranges).select(
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.try_divide("cum_pos", "all_pos").alias("recall"),
    )
    end = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end).orderBy(F.col("threshold").desc())


def _area() -> Column:
    """Trapezoids; the height before a point is its count without its own rows."""
    strip = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)
    return F.try_divide(F.sum(strip), F.max("all_pos") * F.max("all_neg"))


def _average_precision() -> Column:
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return F.try_divide(F.sum(F.col("pos") * precision), F.max("all_pos"))


def roc_auc(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    curve = threshold_counts(scored, ranges)
    return curve.agg(_area().alias("roc_auc"))


def average_precision(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    curve = threshold_counts(scored, ranges)
    return curve.agg(_average_precision().alias("average_precision"))


def ranking_quality(scored: DataFrame, ranges: int | None = None) -> DataFrame:
    """Both areas from one pass over the curve."""
    curve = threshold_counts(scored, ranges)
    return curve.agg(
        _area().alias("roc_auc"), _average_precision().alias("average_precision")
    )

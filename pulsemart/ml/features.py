"""Feature engineering for the churn model, over the tenant health mart."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.config import EMPLOYEE_SIZES, HealthConfig
from pulsemart.functions import day_literal, days_between, steps

# Ordinal codes and the model's feature list.
PLAN_CODES = ("starter", "business", "enterprise")
STAGE_CODES = ("onboarding", "active", "at-risk", "churned")
ONE_HOT = {"src": "acquisition_source", "rgn": "region", "ind": "industry"}
UNKNOWN = "unknown"
BASE_FEATURES = (
    "arr",
    "days_to_renewal",
    "contract_age_months",
    "plan_encoded",
    "employee_size_encoded",
    "pov_started",
    "days_since_cs_touch",
    "cs_touches_90d",
    "total_events_30d",
    "total_events_60d",
    "total_events_90d",
    "hv_events_30d",
    "hv_share_30d",
    "active_days_30d",
    "active_users_30d",
    "usage_trend_ratio",
    "total_events_recent_4w",
    "total_events_prior_4w",
    "total_users",
    "active_users",
    "active_user_pct",
    "score_active_users",
    "score_event_volume",
    "score_hv_share",
    "score_trend",
    "score_cs_touch",
)
LEAKY_FEATURES = ("lifecycle_encoded",)


def _code(column: str, codes, default: int) -> Column:
    c = F.col(column)
    return steps([(c == value, i) for i, value in enumerate(codes)], default)


def churn_features(mart: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """The mart with the engineered columns; ``pov_started`` becomes 0/1."""
    today = day_literal(cfg.snapshot)
    return mart.withColumns(
        {
            "days_to_renewal": F.coalesce(days_between(F.col("renewal_date"), today), F.lit(999)),
            "contract_age_months": F.coalesce(
                days_between(today, F.col("contract_start_date")) / 30, F.lit(0.0)
            ),
            "plan_encoded": _code("plan", PLAN_CODES, 0),
            "employee_size_encoded": _code("employee_size", EMPLOYEE_SIZES, 0),
            "lifecycle_encoded": _code("lifecycle_stage", STAGE_CODES, 1),
            "pov_started": F.coalesce(F.col("pov_started"), F.lit(False)).cast("int"),
        }
    )


def categories(mart: DataFrame) -> list[tuple[str, str]]:
    """(prefix, value) pairs present in the data, sorted within each prefix: the names of the model's features."""
    found = (
        mart.select(*[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(p) for p, c in ONE_HOT.items()])
        .unpivot([], list(ONE_HOT), "prefix", "value")
        .distinct()
        .collect()
    )
    order = list(ONE_HOT)
    return sorted(((r.prefix, r.value) for r in found), key=lambda pair: (order.index(pair[0]), pair[1]))


def one_hot_features(df: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """One 0/1 column ``<prefix>_<value>`` per category; NULL is the category `unknown`."""
    pairs = categories(df) if pairs is None else pairs
    return df.select("*", *[one_hot(prefix, value).alias(f"{prefix}_{value}") for prefix, value in pairs])


def one_hot(prefix: str, value: str) -> Column:
    return (F.coalesce(F.col(ONE_HOT[prefix]), F.lit(UNKNOWN)) == value).cast("int")


def feature_names(pairs: list[tuple[str, str]], include_leaky: bool = False) -> list[str]:
    leaky = LEAKY_FEATURES if include_leaky else ()
    return [*BASE_FEATURES, *leaky, *[f"{p}_{v}" for p, v in pairs]]


def feature_selection(
    features: DataFrame, pairs: list[tuple[str, str]], include_leaky: bool = False
) -> DataFrame:
    """Add the ``features`` vector in the order of `feature_names`; NULL counts as 0.

    Categories are looked up by index and stored sparsely, so a row's size and the plan do
    not grow with their number.
    """
    stages = feature_stages(features, pairs, include_leaky)
    return stages.transform(features).select(*features.columns, "features")


def feature_stages(features: DataFrame, pairs: list[tuple[str, str]], include_leaky: bool = False) -> PipelineModel:
    """What `feature_selection` does as a pipeline that can be stored: fills, indexers, encoder, assembler.

    A value outside ``pairs`` has an index of its own, the last, which the encoder leaves out:
    a category that was not there in training adds nothing.
    """
    leaky = LEAKY_FEATURES if include_leaky else ()
    numbers = [*BASE_FEATURES, *leaky]
    fills = [f"coalesce(CAST({c} AS DOUBLE), 0D) AS _number_{c}" for c in numbers]
    fills += [f"coalesce({c}, '{UNKNOWN}') AS _category_{p}" for p, c in ONE_HOT.items()]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(fills)} FROM __THIS__")]
    shown = [p for p in ONE_HOT if any(p == prefix for prefix, _ in pairs)]
    columns = [f"_number_{c}" for c in numbers]
    if shown:
        indexes, vectors = ([f"_{kind}_{p}" for p in shown] for kind in ("index", "vector"))
        for p, index in zip(shown, indexes):
            labels = [v for prefix, v in pairs if prefix == p]
            stages.append(StringIndexerModel.from_labels(labels, f"_category_{p}", index).setHandleInvalid("keep"))
        # The encoder learns sizes only, from the indexers.
        indexed = PipelineModel(stages).transform(features.limit(0))
        stages.append(OneHotEncoder(inputCols=indexes, outputCols=vectors, dropLast=True).fit(indexed))
        columns += vectors
    return PipelineModel([*stages, VectorAssembler(inputCols=columns, outputCol="features")])

"""User and event aggregates at tenant grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.config import HealthConfig, Window
from pulsemart.functions import ratio_or_zero, sql_text, week_start

# Days fit into 64-bit words; staying below 63 keeps every word positive.
BITS_PER_WORD = 62


def user_metrics(users: DataFrame) -> DataFrame:
    return (
        users.where(F.col("tenant_id").isNotNull())
        .groupBy("tenant_id")
        .agg(
            F.count("user_id").alias("total_users"),
            F.count_if("is_active").alias("active_users"),
            F.count_if(F.col("role") == "admin").alias("admin_count"),
        )
        .withColumn("active_user_pct", F.col("active_users") / F.greatest("total_users", F.lit(1)))
    )


def _at(cfg: HealthConfig, days_back: int) -> str:
    """Midnight ``days_back`` days before the snapshot, as an SQL literal."""
    return f"TIMESTAMP_NTZ'{cfg.day(days_back)} 00:00:00'"


def _inside(window: Window, cfg: HealthConfig) -> str:
    return f"event_time BETWEEN {_at(cfg, window.start_days)} AND {_at(cfg, window.end_days)}"


def _names(events: tuple[str, ...]) -> str:
    return "event_name IN (" + ", ".join(map(sql_text, events)) + ")"


def _day_word(word: int) -> str:
    """One bit for the event's day if it falls into this word of the calendar mask."""
    first = word * BITS_PER_WORD
    return (
        f"CASE WHEN days_back BETWEEN {first} AND {first + BITS_PER_WORD - 1}"
        f" THEN shiftleft(1L, days_back - {first}) END"
    )


def _days_in(mask: str, words: int, oldest: int, newest: int) -> str:
    """Distinct days of a mask with ``newest <= days_back <= oldest``."""
    counts = []
    for word in range(words):
        first = word * BITS_PER_WORD
        wanted = sum(1 << (d - first) for d in range(newest, oldest + 1) if 0 <= d - first < BITS_PER_WORD)
        if wanted:
            counts.append(f"bit_count(coalesce({mask}_{word}, 0L) & {wanted}L)")
    return " + ".join(counts) or "0"


def _tenant_usage(events: DataFrame, cfg: HealthConfig) -> DataFrame:
    """All windows of a tenant in one pass, exact, without expanding rows.

    First level: (tenant, user), combined before its shuffle, so a tenant holding
    a third of the events is spread over its users. Distinct users then are plain
    counts. Distinct days are bits of a calendar mask. A window ends at midnight,
    so of its last day only events at that very instant count; those have their
    own mask.
    """
    words = cfg.longest_window // BITS_PER_WORD + 1
    expansion, split = _names(cfg.expansion_events), _at(cfg, cfg.expansion_recent_days)
    since = _at(cfg, cfg.expansion_prior_days)

    per_user = [
        "max(event_time) AS last_event_date",
        f"sum(event_count) FILTER (WHERE {expansion} AND event_time >= {split}) AS pp_recent",
        f"sum(event_count) FILTER (WHERE {expansion} AND event_time >= {since} AND event_time < {split})"
        " AS pp_prior",
    ]
    per_tenant = [
        "max(last_event_date) AS last_event_date",
        "sum(pp_recent) AS pp_recent",
        "sum(pp_prior) AS pp_prior",
    ]
    for word in range(words):
        bit = _day_word(word)
        per_user += [
            f"bit_or({bit}) AS days_{word}",
            f"bit_or({bit}) FILTER (WHERE event_time = cast(event_date AS TIMESTAMP_NTZ)) AS edge_{word}",
        ]
        per_tenant += [f"bit_or({mask}_{word}) AS {mask}_{word}" for mask in ("days", "edge")]
    for w in cfg.windows:
        inside, s = _inside(w, cfg), w.suffix
        per_user += [
            f"sum(event_count) FILTER (WHERE {inside}) AS total_{s}",
            f"sum(event_count) FILTER (WHERE {inside} AND is_high_value) AS hv_{s}",
            f"max({inside}) AS seen_{s}",
        ]
        per_tenant += [
            f"coalesce(sum(total_{s}), 0) AS total_events_{s}",
            f"coalesce(sum(hv_{s}), 0) AS hv_events_{s}",
            f"count_if(seen_{s} AND user_id IS NOT NULL) AS active_users_{s}",
            f"max(seen_{s}) AS seen_{s}",
        ]
    by_tenant = (
        events.where("tenant_id IS NOT NULL")
        .withColumn("days_back", F.datediff(F.lit(cfg.snapshot), "event_date"))
        .groupBy("tenant_id", "user_id")
        .agg(*[F.expr(e) for e in per_user])
        .groupBy("tenant_id")
        .agg(*[F.expr(e) for e in per_tenant])
    )
    active_days = [
        f"cast({_days_in('days', words, w.start_days, w.end_days + 1)}"
        f" + {_days_in('edge', words, w.end_days, w.end_days)} AS BIGINT) AS active_days_{w.suffix}"
        for w in cfg.windows
    ]
    return by_tenant.selectExpr("*", *active_days)


def window_columns(cfg: HealthConfig) -> list[str]:
    return [
        f"{metric}_{w.suffix}"
        for w in cfg.windows
        for metric in ("total_events", "hv_events", "active_days", "active_users")
    ]


def event_windows(events: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Five windows x four measures for every tenant with an event in any of them."""
    newest = min(w.end_days for w in cfg.windows)
    span = f"event_time BETWEEN {_at(cfg, cfg.longest_window)} AND {_at(cfg, newest)}"
    seen = " OR ".join(f"seen_{w.suffix}" for w in cfg.windows)
    return _tenant_usage(events.where(span), cfg).where(seen).select("tenant_id", *window_columns(cfg))


def last_event(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("tenant_id").isNotNull())
        .groupBy("tenant_id")
        .agg(F.max("event_time").alias("last_event_date"))
    )


def tenant_usage(events: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Window metrics and expansion trend of every tenant seen since the oldest window start.

    Tenants without an event in the first (30-day) window get no window metrics,
    not even for the longer windows: that window is the base of the reference
    result. The same base makes the scan of older events unnecessary for
    ``last_event_date``.
    """
    oldest = max(cfg.longest_window, cfg.expansion_prior_days)
    usage = _tenant_usage(events.where(f"event_time >= {_at(cfg, oldest)}"), cfg)
    base = f"seen_{cfg.windows[0].suffix}"
    return usage.selectExpr(
        "tenant_id",
        f"{base} AS in_base",
        *[f"CASE WHEN {base} THEN {c} END AS {c}" for c in [*window_columns(cfg), "last_event_date"]],
        "coalesce(pp_recent, 0) > coalesce(pp_prior, 0) AS pp_growing",
    )


def with_usage_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "usage_trend_ratio": ratio_or_zero(
                F.col("total_events_recent_4w"), F.col("total_events_prior_4w")
            ),
            "hv_share_30d": ratio_or_zero(F.col("hv_events_30d"), F.col("total_events_30d")),
        }
    )


def event_metrics(events: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    usage = tenant_usage(events, cfg).where("in_base")
    return with_usage_ratios(usage.select("tenant_id", *window_columns(cfg), "last_event_date"))


def pp_trend(events: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Expansion-event sums of the last 30 days against the 30 before, one scan."""
    split, since = _at(cfg, cfg.expansion_recent_days), _at(cfg, cfg.expansion_prior_days)
    return (
        events.where(
            f"tenant_id IS NOT NULL AND {_names(cfg.expansion_events)} AND event_time >= {since}"
        )
        .groupBy("tenant_id")
        .agg(
            F.expr(f"coalesce(sum(event_count) FILTER (WHERE event_time >= {split}), 0)").alias("pp_events_30d"),
            F.expr(f"coalesce(sum(event_count) FILTER (WHERE event_time < {split}), 0)").alias(
                "pp_events_prior_30d"
            ),
        )
        .withColumn("pp_growing", F.col("pp_events_30d") > F.col("pp_events_prior_30d"))
    )


def weekly_activity(events: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Tenant x Monday week. Two levels like `_tenant_usage`; a week's days are seven bits."""
    start = _at(cfg, 7 * cfg.weekly_weeks)
    return (
        events.where(f"tenant_id IS NOT NULL AND event_time >= {start}")
        .groupBy("tenant_id", week_start(F.col("event_date")).alias("week_start"), "user_id")
        .agg(
            F.sum("event_count").alias("n"),
            F.expr("sum(event_count) FILTER (WHERE is_high_value)").alias("hv"),
            F.expr("bit_or(shiftleft(1, weekday(event_date)))").alias("days"),
        )
        .groupBy("tenant_id", "week_start")
        .agg(
            F.expr("coalesce(sum(n), 0)").alias("event_count"),
            F.expr("coalesce(sum(hv), 0)").alias("hv_event_count"),
            F.count("user_id").alias("active_users"),
            F.expr("cast(bit_count(bit_or(days)) AS BIGINT)").alias("active_days"),
        )
    )

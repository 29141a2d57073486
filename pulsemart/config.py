"""Every date, window, threshold and event-name set the operators share."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

# They define the score, the tiers and the flags, so results depend on them.
HIGH_VALUE_EVENTS = (
    "policy_created",
    "risky_workspace_resolved",
    "sensitivity_label_applied",
    "license_recommendation_applied",
)
EXPANSION_EVENTS = ("pp_sync_completed", "pp_sync_started")
EMPLOYEE_SIZES = ("1-50", "51-200", "201-1000", "1000+")
VALID_ROLES = ("admin", "member", "read-only")
TIERS = ("Healthy", "Neutral", "At Risk", "Red Alert", "Churned")


@dataclass(frozen=True)
class Window:
    """Closed look-back ``[snapshot - start_days, snapshot - end_days]``, both at midnight."""

    suffix: str
    start_days: int
    end_days: int = 0


@dataclass(frozen=True)
class HealthConfig:
    snapshot: date = date(2024, 6, 30)

    windows: tuple[Window, ...] = (
        Window("30d", 30),
        Window("60d", 60),
        Window("90d", 90),
        Window("recent_4w", 28),
        Window("prior_4w", 56, 28),
    )
    weekly_weeks: int = 12
    crm_days: int = 90
    blind_spot_days: int = 60
    renewal_days: int = 90
    never_touched_days: int = 999

    high_value_events: tuple[str, ...] = HIGH_VALUE_EVENTS
    expansion_events: tuple[str, ...] = EXPANSION_EVENTS
    expansion_recent_days: int = 30
    expansion_prior_days: int = 60
    expansion_min_users: int = 4

    # Score weights (points) and the points where each component saturates.
    points_active_users: float = 25.0
    points_event_volume: float = 20.0
    points_hv_share: float = 20.0
    volume_ratio_cap: float = 2.0
    hv_share_full: float = 0.40
    trend_steps: tuple[tuple[float, float], ...] = ((1.2, 20.0), (0.8, 10.0))
    touch_steps: tuple[tuple[int, float], ...] = ((30, 15.0), (60, 10.0), (90, 5.0))
    tier_cuts: tuple[tuple[float, str], ...] = (
        (80.0, "Healthy"),
        (60.0, "Neutral"),
        (40.0, "At Risk"),
    )
    tier_floor: str = "Red Alert"
    tier_churned: str = "Churned"

    churn_threshold: float = 0.35
    seed: int = 42
    folds: int = 5

    tiers: tuple[str, ...] = field(default=TIERS)

    def day(self, days_back: int) -> date:
        """Calendar day ``days_back`` before the snapshot (negative: after it)."""
        return self.snapshot - timedelta(days=days_back)

    @property
    def longest_window(self) -> int:
        return max(w.start_days for w in self.windows)

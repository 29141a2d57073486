"""Customer-health analytics for subscription software, as Spark DataFrame jobs."""

from pulsemart.config import HealthConfig

__all__ = ["HealthConfig"]

"""barmill: market price bars through bronze, silver and gold on Spark."""

from barmill.config import DAY, HOUR, Granularity, MaskKey, RunConfig

__all__ = ["DAY", "HOUR", "Granularity", "MaskKey", "RunConfig"]

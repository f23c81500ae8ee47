"""Field-operations analytics as plain PySpark DataFrame jobs."""

from fieldstats.params import JobParams

__all__ = ["JobParams"]

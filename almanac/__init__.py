"""Almanac: indicator time-series processing expressed as Spark DataFrame jobs."""

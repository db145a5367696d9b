"""Spark operators that turn short social posts into weather-sentiment tables."""

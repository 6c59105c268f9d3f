"""Spark-native analytics for ticks, bars, returns, trades and strategy catalogues."""

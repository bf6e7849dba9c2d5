"""Forecast-feature analytics on Spark: as-of joins, summaries, ladders, scores and calibration as DataFrame operators."""

"""Clickstream analytics on Spark: archive, flash-sale alerts and daily reports."""

"""Indicators of healthy, sustainable urban areas as Spark DataFrame operators."""

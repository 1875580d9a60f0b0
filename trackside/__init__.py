"""Timed sensor data on Spark: messages, laps, summaries, live windows.

Every operator is a plain function from DataFrame to DataFrame. The caller owns
the SparkSession and may pass a batch or a streaming frame wherever the
docstring does not say otherwise.
"""

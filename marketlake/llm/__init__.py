"""Operators of a training-data pipeline: ten text, vector and page operators that run as Spark jobs."""

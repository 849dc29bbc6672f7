"""Prediction-market time series on Spark: normalise, merge, resume, resolve, audit and refresh."""

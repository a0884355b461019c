"""Operators: DataFrames in, DataFrame out; only fitting a model runs a job."""

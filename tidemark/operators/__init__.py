"""Cleaning, profiling, feature and aggregate operators: DataFrame in, DataFrame out."""

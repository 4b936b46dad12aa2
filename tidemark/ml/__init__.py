"""Churn model training, threshold choice, attribution and scoring on Spark ML."""

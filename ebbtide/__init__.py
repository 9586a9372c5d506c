"""Churn analytics on Spark: raw order tables in, scored customers out."""

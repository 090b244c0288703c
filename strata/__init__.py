"""Strata: order and click events, from raw JSON to trusted tables and answers, on PySpark."""

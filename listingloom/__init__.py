"""Consolidation of product listings on Spark DataFrames."""

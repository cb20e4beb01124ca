"""Readers. Each returns DataFrames; parsing is done by Spark expressions."""

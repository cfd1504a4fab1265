"""Reusable analytics operators on Spark DataFrames and streams."""

"""Sentiment analytics over a feed of short posts, on Spark DataFrames and streams."""

"""sourcelens: review, annotate and index source/text corpora with Spark DataFrames."""

__all__ = ["session"]

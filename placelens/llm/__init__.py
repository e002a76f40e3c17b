"""Operators for training-data corpora: text, urls, vectors and conversations as Spark jobs."""

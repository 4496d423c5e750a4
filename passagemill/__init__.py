"""Preparation of tagged text corpora as chat-format data sets, as Spark jobs."""

"""Equity-research analytics on Spark: news corpora, price bars, statements, labels, run logs."""

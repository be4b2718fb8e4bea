"""Wiremere: news articles to market signals, as Spark DataFrame jobs."""

"""Martlet: a retail warehouse and its analytics, written as Spark DataFrame jobs."""

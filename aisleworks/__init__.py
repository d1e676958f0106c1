"""Retail sales and stock analytics expressed as Spark DataFrame jobs."""

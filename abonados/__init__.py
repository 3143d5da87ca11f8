"""Telecom customer analytics on Spark: raw JSON documents to business metrics."""

"""Filigrain: batch evidence retrieval and evaluation as declarative Spark plans."""

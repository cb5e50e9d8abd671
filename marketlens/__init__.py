"""Catalogue analytics, warehouse loading and recommendations as Spark plans."""

"""Catalogue search, curation and corpus analytics as Spark DataFrame operators."""

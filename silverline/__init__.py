"""Catalog cleaning, entity building and feature derivation as Spark DataFrame operators."""

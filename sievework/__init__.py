"""Sievework: curation of instruction and code corpora as Spark DataFrame operators."""

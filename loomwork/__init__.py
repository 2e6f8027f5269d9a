"""Loomwork: text retrieval, enrichment and corpus preparation as Spark DataFrame operators."""

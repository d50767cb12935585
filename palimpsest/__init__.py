"""Palimpsest: document enrichment and rewrite-integrity engine on PySpark."""

__version__ = "0.1.0"

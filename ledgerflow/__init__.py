"""Money-flow analytics on Spark: sources, graph tables, enrichment, summaries and upstream tracing."""

__version__ = "0.1.0"

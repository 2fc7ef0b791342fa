"""Film-catalogue analytics on Spark: sources, cleaning, star schema, documents, queries."""

__version__ = "0.1.0"

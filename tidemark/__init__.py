"""tidemark: lakehouse tables, models and data-quality checks as Spark jobs."""

__version__ = "0.1.0"

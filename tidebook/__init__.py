"""tidebook: position analytics and metadata catalogs as Spark DataFrame jobs."""

__version__ = "0.1.0"

"""tessella: a Spark-first engine for large document collections."""

__version__ = "0.1.0"

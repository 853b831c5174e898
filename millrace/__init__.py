"""millrace: an incremental commerce and marketing lakehouse written as Spark DataFrame jobs."""

__version__ = "0.1.0"

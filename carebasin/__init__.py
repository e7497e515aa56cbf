"""Claims and clinical-records analytics as plain Spark DataFrame code."""

__version__ = "0.1.0"

"""Claims analytics on Spark: clean, reconcile, report, model and audit."""

__version__ = "0.1.0"

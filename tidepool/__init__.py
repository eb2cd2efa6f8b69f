"""tidepool: Spark-first graph, log and run analytics built from DataFrame plans."""

__version__ = "0.1.0"

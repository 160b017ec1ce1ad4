"""flowspark: run, audit and analyse SQL step flows and the logs around them, on Spark."""

__version__ = "0.1.0"

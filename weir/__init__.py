"""weir: the batch, SQL and streaming data jobs of a small data-engineering
course workload, rebuilt as Spark DataFrame / SQL / Structured Streaming
jobs. See README.md for the map of modules."""

__version__ = "0.1.0"

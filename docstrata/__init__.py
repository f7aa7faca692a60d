"""Document snapshot analytics on Spark: versioned page collections as DataFrames."""

__version__ = "0.1.0"

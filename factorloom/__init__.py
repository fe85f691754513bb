"""factorloom: panel factor analytics and training-data cleaning on Spark DataFrames."""

__version__ = "0.1.0"

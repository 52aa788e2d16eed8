"""Data movement on Spark: merging text shards, bulk loading query results and
replicating versioned tables.  Every step is a DataFrame plan."""

__version__ = "0.1.0"

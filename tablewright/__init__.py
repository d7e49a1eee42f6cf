"""Feature tables on Spark: raw snapshots to checked, served feature tables."""

__version__ = "0.1.0"

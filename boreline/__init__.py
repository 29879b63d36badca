"""Stage, label and score equipment telemetry with Spark DataFrames."""

__version__ = "0.1.0"

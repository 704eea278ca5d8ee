"""Spark-native operators for relational rewrites and database-server telemetry.

Operators take DataFrames and return DataFrames; nothing is evaluated until
the caller runs an action, except where a docstring says otherwise.
"""

__version__ = "0.1.0"

"""tarnwerk: a Spark-native analytics engine for operational event records.

Every operator takes and returns lazy DataFrames; an action happens only where a docstring says so.
"""

__version__ = "0.1.0"

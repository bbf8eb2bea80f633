"""liftwise: entity-by-day panel metrics and matched difference-in-differences lift on Spark.

Every operator is a function from DataFrames to a DataFrame; nothing is collected
to the driver except small metadata (per-intervention counts, date bounds).
"""

__version__ = "0.1.0"

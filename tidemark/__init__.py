"""tidemark: landing, shaping, reconciling and backfilling lake tables on Spark.

Every operator is a function from DataFrames to DataFrames (or a Column
expression).  Nothing here plans or executes work itself: Catalyst plans it and
executors run it.
"""

__version__ = "0.1.0"

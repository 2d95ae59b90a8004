"""tabkit: Spark-native tabular and text analytics.

Every public operator takes DataFrames and returns DataFrames; the data-sized
work runs on executors and only small results (parameters, a few scalars)
ever reach the driver.
"""

__version__ = "0.1.0"

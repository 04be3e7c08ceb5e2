"""permitflow: Spark-native permit and water-allocation accounting.

Every public operator takes and returns DataFrames, is parameterised by
column names, and leaves physical planning to Catalyst and AQE.
"""

__version__ = "0.1.0"

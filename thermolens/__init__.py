"""thermolens: Spark-native anomaly analytics for heating-sensor temperature series.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark SQL windows, aggregates and joins.  See README.md for the module map.
"""

__version__ = "0.1.0"

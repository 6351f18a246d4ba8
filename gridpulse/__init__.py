"""gridpulse: Spark-native analytics over hourly energy, exchange and weather tables.

Every public operator is a function ``DataFrame(s) -> DataFrame`` built from
Spark SQL expressions, aggregations, joins and windows. Nothing is collected
to the driver; the caller decides when to act (``write``, ``collect``...).
"""

__version__ = "0.1.0"

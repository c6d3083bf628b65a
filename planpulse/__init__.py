"""planpulse: subscription and appointment lifecycle metrics on Spark.

Every operator is a function from DataFrames (plus an explicit as-of date)
to a DataFrame, built from Spark SQL expressions, windows, joins and
aggregates, so Catalyst and AQE choose the physical plan.
"""

__version__ = "0.1.0"

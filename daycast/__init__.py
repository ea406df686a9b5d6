"""daycast: leakage-safe hourly-series features and day-ahead forecast evaluation on Spark.

Every operator takes and returns DataFrames and is built from Spark SQL expressions,
window functions, joins and aggregations, so Catalyst plans the work and it scales
with the number of series and the length of their history.
"""

__version__ = "0.1.0"

"""ratelens: ratings-behaviour analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing is pulled to
the driver except scalars and small bounded tables (split points, centroids,
metrics rows).  See README.md for the module map.
"""

__version__ = "0.1.0"

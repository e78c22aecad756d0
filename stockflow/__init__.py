"""stockflow: retail inventory analytics on Spark DataFrames.

Layout
------
- ``functions``: ``Column -> Column`` builders (retail calendar, movement fields, log fields).
- ``sources``: readers and the mapping of the driver's tables onto the movement / log schemas.
- ``operators``: ``DataFrame -> DataFrame`` operators (reconcile, inventory, runs, logs, demand,
  replenishment, forecasting).
- ``plans``: the movement table sink (window replace, back-fill, compaction) and the named
  query catalogue used by ``__spark_entry__``.
- ``streaming``: Structured Streaming wrappers around the batch operators.
"""

__version__ = "0.1.0"

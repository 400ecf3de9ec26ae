"""signalmine: operational-signal mining and knowledge-base upkeep on Spark.

Every operator is a pure ``DataFrame(s) -> DataFrame`` transform that takes an
explicit ``as_of`` time instead of reading the wall clock. Sub-packages:

* ``sources``   - table loaders, derived fixture views, file scans, sinks
* ``functions`` - column-level helpers (time bounds, text idioms, fixed values)
* ``operators`` - filters, aggregates, joins, windows, table transforms,
                  text extraction, similarity, drift
* ``plans``     - composite jobs and the query catalog
* ``streaming`` - Structured Streaming forms of the incremental jobs
"""

from signalmine.session import get_spark

__all__ = ["get_spark"]

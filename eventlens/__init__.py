"""eventlens: news-event analytics as plain Spark DataFrame jobs.

Layout:
  functions/  column expressions (dates, lookups, lists, safe correlation)
  operators/  the nineteen analyses, each a pure ``DataFrame -> DataFrame``
  sources/    delimited / archive scans, partitioned slot tables, result sinks
  streaming/  incremental ingest with Structured Streaming
  plans/      registry, runner, result views, test-table projections
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions sent to Python workers are pickled by value, so executors need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

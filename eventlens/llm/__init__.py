"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and their SQL.  Functions sent to Python workers are
pickled by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

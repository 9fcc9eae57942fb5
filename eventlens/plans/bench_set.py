"""The headline queries timed by ``bench.py``: the nineteen analyses."""

from eventlens.operators import ANALYSIS_NAMES

BENCH_QUERIES = list(ANALYSIS_NAMES)

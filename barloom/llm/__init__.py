"""Operators for preparing training text: one module each, and their queries."""

import sys

from pyspark import cloudpickle

# Ship this package's functions with the task, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

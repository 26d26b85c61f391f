"""Operators for large-scale training-data preparation.

Functions that run inside Python tasks are shipped by value, so executors
need the third-party packages only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing text and vectors for model training.

Task functions travel to the executors by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

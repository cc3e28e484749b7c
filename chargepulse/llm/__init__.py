"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Functions that run inside
Spark's Python workers are shipped by value, so executors need the third-party
packages only, not this library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

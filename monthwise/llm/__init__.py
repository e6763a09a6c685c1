"""Operators of a large-scale training-data pipeline, each one a Spark job.

Nothing else in the library imports this subpackage.  Functions that run inside
Python workers are pickled by value, so executors need only the third-party
packages, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators a large training-data pipeline needs, beside the race library.

Nothing else in the package imports this subpackage; ``registry`` lists its
queries and their SQL."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage that run in Python workers travel with the
# task, so the executors need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

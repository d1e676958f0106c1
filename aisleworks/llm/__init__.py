"""Operators for preparing text corpora, each built for one job; see the modules."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors by value: a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

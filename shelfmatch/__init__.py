"""shelfmatch: product-catalog matching and prioritisation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.2.0"

# Functions of this package that run in Python workers travel by value, so a
# job needs no copy of the package (and no PYTHONPATH) on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Hierarchical place resolution on Spark: a gazetteer matcher and its evaluation toolkit as DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions go to the executors whole, so that these need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

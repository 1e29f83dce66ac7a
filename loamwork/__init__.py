"""loamwork: analytics operators for tables, text and streams, written on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Helper functions travel to the Python workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

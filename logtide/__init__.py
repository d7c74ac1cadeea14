"""logtide: event-log operators and event analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers get this package's batch functions by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

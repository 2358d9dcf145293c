"""attriflux: ad-performance analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the tasks by value, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

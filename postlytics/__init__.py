"""postlytics: short-post ingestion, cleaning, sentiment and reports as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.2.0"

# Functions of this package travel to the Python workers by value: the workers need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

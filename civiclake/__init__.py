"""civiclake: Spark-native building blocks for auditable public-data lakehouses."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions handed to Python workers travel with the job, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Retrieve-then-rank analytics on interaction tables, written for Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel with the job, so executors need not have
# this package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

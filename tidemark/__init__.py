"""Retail product intelligence on PySpark: extraction, matching, snapshots, quality and reports."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the task, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Catalogue price comparison on Spark: landing, history, matching, reports."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so that executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

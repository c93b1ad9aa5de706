"""Multilingual chat, preference and article-grounded datasets, built on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

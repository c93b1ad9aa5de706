"""Registered queries over the test tables, each with equivalent SQL where SQL can say it."""

import sys

from pyspark import cloudpickle

# As for the package itself: stand-in models travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

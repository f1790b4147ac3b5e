"""Feature, window and profiling engine on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so a cluster needs no copy of
# this package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

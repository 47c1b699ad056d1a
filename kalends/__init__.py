"""kalends: event-listing analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions that run on executors travel with the task, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

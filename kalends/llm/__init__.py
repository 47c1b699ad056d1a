"""Training-data operators. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Python functions that run on executors travel with the task, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

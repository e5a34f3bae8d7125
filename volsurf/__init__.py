"""End-of-day equity option analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

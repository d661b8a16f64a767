"""Commerce funnel analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors whole, so these need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Access-log analytics for package servers, expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel by value: nothing has to be installed
# on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

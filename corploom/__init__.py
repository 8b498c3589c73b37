"""Training-corpus preparation on Spark."""

import sys

from pyspark import cloudpickle

# Python workers get the code of our UDFs with the task itself, so executors
# need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

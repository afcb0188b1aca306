"""Order analytics on Spark DataFrames: validate, price, roll up, deduct stock, forecast."""

import sys

from pyspark import cloudpickle

# The few Python functions travel inside the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

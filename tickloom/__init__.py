"""tickloom: Spark-native processing of trade, quote and bar data."""

import sys

from pyspark import cloudpickle

# functions go to the executors by value: a cluster needs no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

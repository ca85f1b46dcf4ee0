"""Commerce transaction analytics and weekly demand forecasting on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Tasks receive the few Python helpers by value: executors need not have the
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

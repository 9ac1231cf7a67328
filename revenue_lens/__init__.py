"""Order-level revenue analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Grouped-map functions travel with the job by value, so the executors need no copy of this
# package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

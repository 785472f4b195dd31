"""rillmark: usage-to-payout attribution and large-table data processing on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Kernels go to the executors with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Flow analytics on Spark: every public function takes and returns DataFrames or Columns."""

import sys

from pyspark import cloudpickle

__version__ = "1.0.0"

# The few functions that run in Python workers travel with their code, so that executors
# need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

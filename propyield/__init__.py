"""propyield: property-market yield analytics as plain Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few task-side Python functions (workbook decoding, fixture writing) travel to
# the executors by value, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Legal-document processing expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the executors by value, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

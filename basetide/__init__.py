"""basetide: genome site, interval, alignment and tree analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions of this package travel to the executors by value, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

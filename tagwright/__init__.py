"""Spark-native record linkage, price extraction and corpus preparation.

Functions that run in Python workers are pickled by value, so a cluster needs
no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

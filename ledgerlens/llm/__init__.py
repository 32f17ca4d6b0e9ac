"""Operators for building training corpora: cleaning, deduplication, mixing and packing of texts."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job; executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for training-data pipelines on raw text and vectors."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

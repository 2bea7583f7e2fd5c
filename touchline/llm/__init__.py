"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with their code, so that these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

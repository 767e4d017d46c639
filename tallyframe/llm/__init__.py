"""Operators of training-data pipelines. Nothing else in the library imports this package.

Functions that run in Python workers travel with their code, so executors need the library's dependencies
but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

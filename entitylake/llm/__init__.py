"""Operators of a training-data pipeline; nothing else in the library imports this package."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Functions that run in tasks travel with their code, so executors need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

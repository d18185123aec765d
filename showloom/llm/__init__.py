"""Operators for building language-model training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# tasks get the functions of this package with the plan, so executors need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

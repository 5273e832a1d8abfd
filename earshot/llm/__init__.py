"""Operators for preparing training data for language models."""

import sys

from pyspark import cloudpickle

# Tasks get these modules with the function they run, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

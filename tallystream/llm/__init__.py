"""Operators for the preparation of training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with the job, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

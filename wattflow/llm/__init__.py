"""Operators for training-data pipelines, with their registered queries.

Functions of this subpackage travel to Python workers by value, so executors
need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

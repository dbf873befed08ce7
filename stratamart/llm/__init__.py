"""Operators for preparing training data: one module per operator.

Nothing else in the library imports this package. Functions that run inside
Spark tasks travel with the task by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

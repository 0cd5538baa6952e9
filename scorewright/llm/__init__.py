"""Operators for preparing training text: one module per operator, thin queries in ``queries``."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the executors by value, so they need no copy of it on their path.
register_pickle_by_value(sys.modules[__name__])

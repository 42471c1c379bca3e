"""Operators for preparing training data, and their queries."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of these modules travel to the executors by value, so no executor
# needs an installed copy of the package.
register_pickle_by_value(sys.modules[__name__])

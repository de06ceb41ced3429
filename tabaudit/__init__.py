"""Audit and migration of large collections of small, ragged tables, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tabaudit.settings import Settings

__all__ = ["Settings"]

# Python functions of this package travel to the workers by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

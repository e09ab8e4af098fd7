"""Operators for preparing training text. Nothing else in the library imports this package.

Functions defined here travel to Python workers by value, so workers need Spark's own Python
packages and numpy but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training text: filters, deduplication, mixing and packing.

Nothing else in the library imports this package.  ``catalog`` registers one
query per operator, each over its whole table.

Functions of this package travel to the Python workers by value, so executors
need the third-party libraries but no copy of the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

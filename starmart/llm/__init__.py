"""Operators for preparing training data from large text tables.

Functions of this package that run inside tasks are sent there by value, so executors
need the libraries it imports, but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

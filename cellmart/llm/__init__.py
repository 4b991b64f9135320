"""Operators for preparing text corpora; nothing outside this package imports it.

What runs in Python workers travels to them by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

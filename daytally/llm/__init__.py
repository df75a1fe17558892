"""Operators for preparing training text, one module each.

Functions that run in tasks are pickled by value, so executors need the
third-party packages but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

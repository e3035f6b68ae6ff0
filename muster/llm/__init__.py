"""Operators that prepare a text corpus for training; nothing else in the library imports them.

Functions that run in Python workers are sent by value, so executors need the third-party packages
but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for training-data pipelines; nothing else in the library imports them.

What tasks run in Python is sent to them whole, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training data at scale; nothing else in the package imports them.

Functions that run inside Spark tasks are pickled by value, so executors need the third-party
libraries they use but not this package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

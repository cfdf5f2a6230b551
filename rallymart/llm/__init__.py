"""Operators for preparing language-model training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with them, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing text corpora; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Executors get the code of these modules with the task; they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

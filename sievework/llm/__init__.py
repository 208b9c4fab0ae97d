"""Operators for building training corpora; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so only numpy, pyarrow and
# tokenizers have to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

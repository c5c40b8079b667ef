"""Operators for training-data pipelines; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# What tasks run travels with them, so that executors need only the public libraries.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

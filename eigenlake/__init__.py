"""Dimensionality reduction and cluster evaluation of numeric tables on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to tasks carry their code with them, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

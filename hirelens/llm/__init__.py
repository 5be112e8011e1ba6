"""Operators of a training-data pipeline over documents, pages and embeddings.

Each module holds one operator with a general interface; ``queries`` applies
them to the given tables.  Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

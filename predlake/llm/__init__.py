"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage. Every operator is a
function ``DataFrame -> DataFrame``; ``queries.py`` binds each one to its table
with production parameters.
"""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value: these need not have the package on
# their path. Broadcasts hold plain data (numpy arrays, dicts), never classes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

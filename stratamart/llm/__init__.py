"""Operators for training-data pipelines over documents, pages and embeddings.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so executors
# need no copy of the package on their Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training data: documents, pages and embeddings.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the tasks that run
# them, so executors need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""sidweave: recommendation-corpus building and evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

# Ship functions used inside tasks by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

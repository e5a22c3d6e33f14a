"""Operators of a training-data pipeline over documents, pages and embeddings."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so that workers need
# not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

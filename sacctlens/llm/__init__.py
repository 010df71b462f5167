"""Operators of a training-data pipeline over documents and embeddings.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries
only where it is present.  Every operator is a function from DataFrames to a
DataFrame; per-task Python works on Arrow batches with numpy.
"""

import sys

from pyspark import cloudpickle

# Tasks carry this folder's functions along, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

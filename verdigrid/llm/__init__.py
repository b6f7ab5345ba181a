"""Operators for training-data pipelines on tables of documents, pages and vectors.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""

import sys

from pyspark import cloudpickle

# batch functions travel with the job: executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

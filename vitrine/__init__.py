"""Vitrine: a text-catalogue engine expressed as Spark DataFrame jobs.

``functions``  column expressions (cleaning, prompts, n-grams, hashing)
``operators``  DataFrame -> DataFrame transformations (dedup, top-k, BM25, metrics, ...)
``sources``    readers and writers
``plans``      the composite jobs, the registered queries and their SQL twins
``streaming``  the same jobs over a micro-batch stream
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package on their path: task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"

"""Operators for training-data corpora, built on Spark. Nothing else in the library imports this package."""

from pyspark import cloudpickle

import firnline.llm as _package

# Functions sent to executors travel with their code, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(_package)

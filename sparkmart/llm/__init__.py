"""Operators of a training-data pipeline over documents, embeddings and conversations.

Nothing else in the library imports this package; ``queries.py`` registers one query per operator.
Functions that run in tasks are sent by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

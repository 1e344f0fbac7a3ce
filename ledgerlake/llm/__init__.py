"""Operators for preparing large text corpora for model training.

Each module holds one operator with a general interface; ``queries`` applies them to whole
tables.  Functions that run inside tasks are pickled by value, so executors need this package
neither installed nor on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

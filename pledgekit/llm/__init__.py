"""Operators for preparing text corpora at scale; nothing else in the library imports this package.

Functions that run in tasks travel with their code, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])

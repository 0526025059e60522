"""Operators of a training-data pipeline over text documents, one module each.

Functions that run inside tasks travel by value, so executors need numpy and pyarrow
but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

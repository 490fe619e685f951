"""Operators of a training-data pipeline; nothing outside this subpackage imports it.

Functions of this subpackage that run inside tasks travel to the executors by
value, so that the executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

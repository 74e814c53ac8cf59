"""Operators for training corpora. Nothing else in the library imports them.

Their functions travel to the executors with the query, so nothing has to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

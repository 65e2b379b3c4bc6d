"""Operators for preparing training data. Nothing else in the library imports this subpackage.

Functions that run inside tasks travel to the workers by value, so the workers
need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

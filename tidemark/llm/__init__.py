"""Operators for training data: packing, filters, near-duplicate search, repeated passages, models of text, token counts.

Nothing else in the library imports this package. Functions sent to executors travel by value, so a cluster needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

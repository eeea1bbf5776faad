"""Operators of a training-data pipeline: quality, personal data, near copies, archives, tokens, toxicity, packing.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators of a large-scale training-data pipeline, and their queries (``registry``).

Their functions travel to the executors by value, so no package has to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for a large-scale training-data pipeline.

Each module holds one operator with its own general interface; ``queries``
holds the thin whole-table queries over them.  Nothing else in the library
imports this subpackage.  Functions that run inside tasks are shipped by
value, so executors need only the public packages.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

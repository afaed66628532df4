"""Operators for preparing training text at scale, and their queries.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are shipped by value, so executors need only the public
packages, not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

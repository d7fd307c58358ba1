"""Training-data operators: one module per operator, `queries` registers them.

Functions that run in Python workers are sent by value, so executors need the
public libraries the operators use, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

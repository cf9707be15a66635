"""Operators for preparing training text, all on Spark tables.

Tasks get this package's code with their functions, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training data. Nothing else in the library imports this.

Python code of these modules travels to the executors by value, so that they need no
installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

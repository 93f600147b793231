"""Operators of a training-data pipeline. Nothing else in the library imports this package.

What runs in tasks is sent with the task, so workers need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

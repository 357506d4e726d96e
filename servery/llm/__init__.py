"""Operators for the preparation of training data. Nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# What runs inside tasks travels with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training corpora: each module is one operator, ``queries`` registers them."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with their code, so that these need no copy of the
# package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

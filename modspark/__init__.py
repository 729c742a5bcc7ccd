"""Text-moderation analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python workers get the functions of this package by value, so that a cluster needs no
# copy of it on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators of a large-scale training-data pipeline, as Spark jobs."""

import sys

from pyspark import cloudpickle

# executors get the operators' functions with the job: they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

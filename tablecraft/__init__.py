"""Dataframe, feature, text, graph and model operators as plain Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers whole, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

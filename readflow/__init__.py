"""readflow: content-reading analytics and recommendation as Spark jobs."""

import sys

from pyspark import cloudpickle

from readflow.session import configure, materialize, scratch, scratch_path

# Task functions go to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["configure", "materialize", "scratch", "scratch_path"]

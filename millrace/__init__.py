"""Spark jobs that land, refine and check operational lending data."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the workers with the job, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

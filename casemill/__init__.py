"""casemill: complaint and case analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Task code travels with its definition, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

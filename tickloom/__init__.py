"""Price-bar and survey-statistics operators as Spark jobs."""

import sys

from pyspark import cloudpickle

# the small helpers that run inside tasks travel with the task, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

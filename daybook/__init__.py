"""daybook: task, note and focus-timer analytics as Spark DataFrame jobs.

Every job takes DataFrames and returns DataFrames; rows of many users are
processed together and ``user_id`` is the partition key throughout.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers (Arrow batch passes) are shipped with
# the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

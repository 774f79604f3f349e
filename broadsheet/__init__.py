"""Clean, enrich and search tables of business-news articles with Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# Functions that run inside tasks travel with the job, so executors need no
# copy of this package.
register_pickle_by_value(sys.modules[__name__])

"""Label text collections with a taxonomy, as plain PySpark jobs.

Public functions take and return DataFrames (or Columns) and stay lazy; the few that must
look at data first (to check a broadcast bound, to iterate over centroids) say so.
"""

import sys

from pyspark import cloudpickle

# The package's functions travel inside the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"

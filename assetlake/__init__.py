"""Dataset quality, versioned builds, run metadata and lineage on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the executors inside the task, so that a cluster
# needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

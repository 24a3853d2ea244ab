"""docweave: document-harvest analytics on Spark."""

import sys

from pyspark import cloudpickle

# Task functions travel with their definitions, so executors need no
# installed copy of the package, wherever the driver was started from.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Training-data operators: search, de-duplication, filtering, scoring and packing."""

import sys

from pyspark import cloudpickle

# worker functions travel by value, so executors need no package install
cloudpickle.register_pickle_by_value(sys.modules[__name__])

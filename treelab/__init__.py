"""Tree-model analytics as Spark jobs: clean, split, fit, sweep, evaluate, explain, compare."""

import sys

from pyspark import cloudpickle

# the small helpers inside vectorised functions travel with the function, so executors need no install
cloudpickle.register_pickle_by_value(sys.modules[__name__])

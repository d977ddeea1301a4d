"""Travel analytics on PySpark: sources, column functions, relational operators, models, streams."""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

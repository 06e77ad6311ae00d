"""Training-data operators: document operators and their registered queries.

Nothing else in the package imports this folder. Its functions go to the executors by value, so
that a cluster needs no copy of the package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

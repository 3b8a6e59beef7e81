"""Training-data operators: near-duplicate, mixing, language, decontamination, packing, sharding.

The functions that run inside tasks are shipped by value, so executors need the
third-party libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

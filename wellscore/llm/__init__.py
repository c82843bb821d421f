"""Training-data operators: privacy, decontamination, dedup, mixing, output and scoring.

Nothing else in the library imports this subpackage. Functions that run inside
Python workers are shipped by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

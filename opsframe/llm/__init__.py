"""Operators that prepare text for training language models.

Their functions travel to the executors inside the tasks, so that executors
need the libraries they use but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

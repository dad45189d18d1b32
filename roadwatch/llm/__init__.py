"""Operators that prepare training text at scale; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the workers with the job, so that executors need no
# copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing text and vectors at the scale of a training corpus."""

import sys

from pyspark import cloudpickle

# Functions go to the tasks whole: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

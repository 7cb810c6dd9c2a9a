"""Operators for preparing training text. Nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Python steps travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for building training corpora, each by one named method."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that nothing has to be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

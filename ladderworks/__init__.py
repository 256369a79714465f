"""Ladderworks: competitive-results and market-share analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Python steps travel to the executors with their code, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

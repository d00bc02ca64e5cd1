"""Operators for preparing training text: dedup, filters, scores, mixing and sharding."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors with their code, so no worker needs this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

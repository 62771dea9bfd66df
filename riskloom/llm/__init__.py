"""Operators of a training-data pipeline: search, scans, classifiers, mixing, tokens, deduplication.

Each operator is a module of its own; ``queries`` applies them to the driver tables. Functions of this
package travel to the executors by value, so nothing has to be installed there but the libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

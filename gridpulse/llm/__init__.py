"""Operators of a training-data pipeline (documents, web pages, benchmarks).

One module per operator; ``queries`` binds them to the given tables. Nothing
outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value: the workers need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

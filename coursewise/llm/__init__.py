"""Operators of a large-scale training-data pipeline (see the README).

Functions of this package that run on executors travel by value, so a cluster
needs no copy of it: only numpy, pyarrow and the tokenizer libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

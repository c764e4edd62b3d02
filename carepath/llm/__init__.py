"""Operators for large-scale text-corpus preparation.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it can be imported.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage go to the executors by value, so these need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators of a training-data pipeline over a ``documents`` table.

Nothing else in the library imports this subpackage.  Its task functions are
shipped to the executors by value, so a cluster needs no copy of the package
on its workers (numpy, pyarrow, xxhash and zstandard must be there).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

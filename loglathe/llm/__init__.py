"""Operations of a training-data pipeline: filters, duplicates, archives, packing, shards.

Each module holds one operator with its own interface and the query that applies it to
the given tables. Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Executors need not have the library installed: task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

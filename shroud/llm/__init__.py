"""Operators for preparing training data: mixing, classifiers, filters, deduplication, encoding.

Nothing else in the library imports this subpackage. Its functions travel to the executors by
value, so executors need numpy and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

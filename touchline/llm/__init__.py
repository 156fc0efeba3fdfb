"""Operators of a training-data pipeline over documents, pages and benchmark items.

Nothing else in the library imports this package. Functions that run inside Python tasks travel with the job by
value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

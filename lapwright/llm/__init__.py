"""Operators of a training-data pipeline: one module per operator, `registry` for the registered queries.

Functions that Spark runs in Python workers are sent with the job, so a worker
needs only the third-party libraries and no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

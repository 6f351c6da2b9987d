"""Readers: CSV export folders, a Python data source, request transports, tables.

Code here also runs inside Spark's Python workers. It is pickled by value, so the
workers need only Spark's own dependencies and not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

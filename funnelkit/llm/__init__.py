"""Corpus operators for training-data pipelines (one method and module each).

Nothing outside this package imports it.  ``registry.QUERIES`` maps the query
names ``opN_<name>`` to (query, DuckDB SQL or None).
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that they
# need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

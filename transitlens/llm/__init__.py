"""Operators for large text corpora: scans, dedup, filtering, formatting, encoding.

Nothing else in the package imports this subpackage. Functions that run in
Python tasks are pickled by value, so executors need the public libraries
(numpy, pyarrow, ...) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

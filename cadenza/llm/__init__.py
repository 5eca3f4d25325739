"""Operators for large text corpora. Nothing else in the library imports this subpackage.

Python code that runs on executors is pickled by value and imports this package
there, so executors need it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

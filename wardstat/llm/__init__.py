"""Operators for large training-data corpora; nothing else in the library imports this package.

What runs in Python workers is shipped with the job, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing language-model training data.

Python code that runs in tasks is pickled by value, so executors need no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

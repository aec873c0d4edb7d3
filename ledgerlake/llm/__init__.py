"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when it is present.

Functions that run in Python workers are pickled by value, so executors need
the libraries these modules import but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for building training data from raw text at scale.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries.py`` registers one thin query per
operator over the test tables.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

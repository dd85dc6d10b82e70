"""Operators for preparing training data at corpus scale.

Each module holds one operator with its own interface; ``queries`` applies
them to the provided tables and derives the registered results.

Functions that run inside tasks travel with their code, so executors need no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

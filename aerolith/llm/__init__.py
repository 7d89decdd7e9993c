"""Operators of a training-data pipeline: licences, secrets, vector search,
deduplication, tokenizing, chat formatting, language id, decontamination.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for training data: quality, extraction, near-duplicates, decontamination, mixing,
language, chat format, language model, token files, search.

Nothing else in the library imports this package. Its functions are sent to the workers by value,
so that executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

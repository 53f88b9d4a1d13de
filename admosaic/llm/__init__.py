"""Operators for large text corpora: filtering, near duplicates, scans, tokens and models.

Every operator takes a table with an id and a text column, under any names, and leaves other columns alone.
Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions that tasks run travel with the task, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators of a training-data pipeline: deduplication, filtering, tokenising,
archiving, scanning, scoring and mixing of document corpora.

Nothing else in the library imports this subpackage. Functions that run inside
Python tasks are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

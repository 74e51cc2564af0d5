"""Operators of a training-data pipeline over large text corpora.

Each module holds one operator with a general interface; :mod:`eventpulse.llm.queries`
applies them to the driver tables. Nothing outside this package imports it.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the executors whole, which need not have it installed.
register_pickle_by_value(sys.modules[__name__])

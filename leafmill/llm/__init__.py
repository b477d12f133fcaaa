"""Operators of a training-data pipeline: documents, pages, conversations and vectors in, clean corpora out.

Nothing else in the library imports this package. Each module is one operator; ``catalog``
registers one query per operator over its whole table.
"""

from pyspark import cloudpickle

import leafmill

# Run from a folder, not installed: functions travel to the Python workers by value.
cloudpickle.register_pickle_by_value(leafmill)

"""Operators of a training-data pipeline over a table of documents.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the thin
registered queries, the other modules one operator each.
"""

import sys

from pyspark import cloudpickle

# code that runs in tasks travels with the task: workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operations of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
registered queries, ``oracle.py`` their DuckDB SQL where SQL can express them.
"""

import sys

from pyspark import cloudpickle

# Tasks carry this subpackage's functions with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

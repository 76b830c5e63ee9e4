"""Operators for training-data pipelines (secrets, licences, search, near
duplicates, toxicity, repeated passages, web archives, chat formatting,
decontamination, mixing).

Nothing outside this subpackage imports it. ``queries.py`` maps the registered
query names to functions and holds the DuckDB SQL where SQL can express a result.
"""

import sys

from pyspark import cloudpickle

# The tasks' functions travel with their code: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

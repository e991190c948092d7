"""rowsmith: raw text and event data as Spark DataFrames.

The package's functions that run inside tasks (the Arrow batch functions of
the archive reader and writer) are pickled by value, so executors need no
copy of the package on their Python path.
"""

import sys

try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - an older cloudpickle still pickles by reference
    pass

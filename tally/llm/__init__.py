"""Training-data operators over text and embedding tables.

Nothing outside this package imports it.  The functions run inside Spark
tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

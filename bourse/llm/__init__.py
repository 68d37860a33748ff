"""Training-data operators: mixing, packing, LM scoring, nearest neighbours,
WARC, line / document / passage de-duplication, quality rules, HTML text.

Nothing else in the library imports this package.  Functions that run on the
executors are pickled by value, so workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

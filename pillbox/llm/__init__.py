"""Training-data operators: mixing, tokenising, language ID, dedup, WARC, quality, LM scoring.

Nothing else in the library imports this subpackage.  Its functions are
pickled by value, so executors need no copy of it on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

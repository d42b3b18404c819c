"""The registered queries, their SQL counterparts and the inputs both derive."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

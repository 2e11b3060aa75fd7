"""Training-data operators; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The operators' functions travel to the executors whole, so no package has to be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

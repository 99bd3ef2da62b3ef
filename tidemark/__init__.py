"""Change history of repeatedly observed records, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python tasks carry the few helper functions they need with them, so workers need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""earshot: podcast-content analytics as set-based PySpark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to the Python workers travel with their code, so the workers
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

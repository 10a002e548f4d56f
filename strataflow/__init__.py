"""strataflow: land raw data in layered tables and refine it, on plain Spark."""

from pyspark import cloudpickle

from strataflow.sources import paged as _paged

# The reader that runs inside executors travels with the job, so workers need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(_paged)

__version__ = "0.1.0"

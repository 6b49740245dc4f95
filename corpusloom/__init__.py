"""Text-dataset preparation, checking and scoring as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers inside the jobs that use them, so
# executors need no installation and no working directory in common with the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

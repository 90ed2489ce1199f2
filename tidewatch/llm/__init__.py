"""Training-data operators: dedup, mixing, scoring, scanning, packing and WARC I/O."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers with the job, so executors need
# not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

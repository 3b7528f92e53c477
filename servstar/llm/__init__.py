"""Operators of a training-data pipeline: deduplication, quality, secrets,
mixing, packing and sharding of a corpus. Nothing else in the library imports
this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job: executors needn't have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

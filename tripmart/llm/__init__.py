"""Operators of a training-data pipeline: rules, search, packing, shards, models, archives, token files, duplicates, spelling and mixes."""

import sys

from pyspark import cloudpickle

# task code travels with the job, so that executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

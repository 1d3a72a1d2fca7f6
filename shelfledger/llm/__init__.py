"""Operators of a training-data pipeline: fingerprints, extraction, sharding, language, tokens,
toxicity, decontamination, near and exact deduplication, packing.

Worker functions are pickled by value, so a cluster needs no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

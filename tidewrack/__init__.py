"""Tidewrack: a Spark-native engine for curating large corpora of transcripts and media-derived signals."""

import sys

from pyspark import cloudpickle

# Python workers need not be able to import this package: its functions travel with the plans that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

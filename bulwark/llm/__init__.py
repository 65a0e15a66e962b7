"""Operators for preparing training text. Nothing outside this folder and corpus_pipeline.py imports it."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

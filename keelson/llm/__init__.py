"""Operators of a training-data pipeline (packing, decontamination, secrets,
repeated-span removal, language-model scoring, similarity join, language id,
exact top-k search, quality and toxicity scoring). Nothing else in keelson
imports this package.

Its functions travel to the tasks by value, so that executors need not have
the package on their path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""keelson: a Spark-native engine for the life of a tabular regression model.

Clean, split, profile, fit, evaluate, tune, track, register, promote and
batch-score, all as DataFrame / SQL / Arrow jobs.
"""

__version__ = "0.1.0"

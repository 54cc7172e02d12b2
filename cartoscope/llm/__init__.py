"""Training-data operators. Nothing else in the library imports this subpackage.

Functions that run in Python workers are pickled by value, so executors need
no copy of this package on their path.
"""

import importlib

from pyspark import cloudpickle

_WORKER_MODULES = ("textscan", "packed", "langid", "simhash", "decontam", "chat", "katz", "toxicity")

for _name in _WORKER_MODULES:
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_name}"))

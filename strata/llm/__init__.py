"""Operators for preparing large text corpora.

Nothing outside this package imports it. Functions that run inside Spark tasks are
shipped by value, so executors need Python, numpy and pyarrow (and pyahocorasick for
toxicity and passages), but not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

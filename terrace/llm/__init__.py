"""Operators for preparing language-model training data.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it. Code
that runs on executors travels by value, so workers need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

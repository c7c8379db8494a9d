"""Operators for preparing language-model training data.

Nothing outside this package imports it. Its functions run inside Python workers, so they travel
with each job by value: executors need numpy, pyarrow and the tokenizer libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

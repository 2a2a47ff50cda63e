"""Operators for building language-model training data; nothing else imports this package."""

import sys

from pyspark import cloudpickle

# Functions run on executors travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

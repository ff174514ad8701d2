"""ridgeway: regularised linear-model fitting over Spark DataFrames.

Layout
------
sources/    labelled-point tables, parameter tables, model/trace sinks
functions/  Column builders: margins, pointwise losses, penalties
operators/  aggregate and table operators (loss/gradient, moments,
            penalties over coefficient tables, multi-model evaluation,
            dual SVM, scoring)
plans/      iterative trainers (driver loops issuing one Spark job per
            step) and the query catalogue used by ``__spark_entry__``
llm/        training-data operators; nothing else in the library imports it
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Executors get the library inside the task closures (functions and classes of
# this package are pickled by value), so the Arrow operators run on a cluster
# where the package is not installed and whatever the driver's working folder.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from .plans.api import fit  # noqa: E402,F401

"""Operators of a training-data pipeline: near duplicates, packing, text scores, filters, tokens.

One module per operator; :mod:`tidemark.llm.queries` registers them. Nothing
else in the package imports this one.

Functions that run in Python workers travel by value, so executors need no copy
of this package; models are broadcast the same way (:func:`tidemark.llm.shared.ship`).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""corpusmill: a Spark-native engine for analysing large text corpora."""

from pyspark import cloudpickle

import corpusmill as _self

# Python workers get the functions by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(_self)

__version__ = "0.1.0"

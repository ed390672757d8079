"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from pyspark import cloudpickle

import worklens.llm as _self

# executors need numpy and Arrow, not a copy of this package: functions travel with the job
cloudpickle.register_pickle_by_value(_self)

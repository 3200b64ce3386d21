"""Event ETL on Spark: framed Avro / JSON topics and CSV files to tables."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors need numpy and
# pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

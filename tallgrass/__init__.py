"""Tallgrass: web-corpus ingestion and curation operators for Apache Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so only the driver needs it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

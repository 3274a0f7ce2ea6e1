"""Distributed data conversion and summarising on PySpark DataFrames.

A job names a source, an ordered list of row operations, a field mapping that
is either a projection or a group-by, and a sink.  Every piece is a plain
DataFrame transformation, so Catalyst sees the whole plan.
"""

import sys

from pyspark import cloudpickle

from millrace.plans.spec import FieldMap, JobSpec, SpecError
from millrace.plans.job import build, run
from millrace.session import get_session, scratch_path

__all__ = ["FieldMap", "JobSpec", "SpecError", "build", "run", "get_session", "scratch_path"]

# Functions of this package travel to the executors with the job, so that they
# need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

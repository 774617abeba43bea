"""Small feed-forward networks trained and scored as Spark jobs.

Parameters, activations, errors and gradients are DataFrames; a layer is a join
with a grouped sum (or an array expression); a training step is one distributed
job whose only small result is the next version of the parameters.
"""

import sys

from pyspark import cloudpickle

from sparkgrad.plans.network import Network, State
from sparkgrad.session import build_session, scratch_path

__all__ = ["Network", "State", "build_session", "scratch_path"]

# Functions sent to the tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

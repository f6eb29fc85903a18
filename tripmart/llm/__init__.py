"""Operators of a training-data pipeline: joins of similar texts, exact
search, quality rules, sharding, suffix dedup, web archives, chat formatting,
language labels, packing and source mixing.

Nothing outside this subpackage imports it. ``queries.py`` registers one query
per operator and ``oracle.py`` holds the SQL of those that SQL can express.
"""

import os
import site
import sys

from pyspark import cloudpickle


def _reachable() -> bool:
    """Whether executors import this package themselves: it is installed, or on
    the PYTHONPATH that they inherit."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    return root in map(os.path.abspath, filter(None, known))


# Otherwise the functions of this subpackage travel with the tasks.
if not _reachable():
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Operators for preparing training data. Nothing else in the library imports this package.

Tasks import this package too. Where it is installed under one path on all nodes, or runs locally, the path is
passed on here; elsewhere submit it with --py-files.
"""

import os

from pyspark import SparkContext

_root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if _root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
    os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (_root, os.environ.get("PYTHONPATH")) if x)
if SparkContext._active_spark_context is not None:
    SparkContext._active_spark_context.environment.setdefault("PYTHONPATH", _root)

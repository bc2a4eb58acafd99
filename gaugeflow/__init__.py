"""Keyed time-series analytics on Spark DataFrames.

Every operator takes and returns DataFrames built from native expressions. The
column names an operator works on come from :class:`gaugeflow.spec.Roles`; the
moment that relative look-backs are measured from is an explicit ``as_of``.
"""

from gaugeflow.spec import Roles

__all__ = ["Roles"]

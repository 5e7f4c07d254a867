"""Governed record pipelines on Spark: ingest, standardise, link, derive, release.

Every operator is a function from DataFrames or Columns to DataFrames or
Columns; nothing runs until a caller acts on the result, except where a
function's name says ``check`` or ``require`` and where it writes.
"""

from .errors import EngineError

__version__ = "0.2.0"

__all__ = ["EngineError", "__version__"]

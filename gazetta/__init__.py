"""Gazetta: building and maintaining reference directories with PySpark.

Every operator is a plain function from DataFrames (or Columns) to DataFrames
(or Columns); Catalyst plans the work.  See README.md for the module map.
"""

__version__ = "0.1.0"

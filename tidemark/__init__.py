"""tidemark: warehouse transformations as Spark DataFrame functions.

Every operator takes DataFrames or Columns and returns DataFrames or Columns.
Nothing reads the clock: an "as of" time is always an argument, so a job run
twice over the same inputs gives the same rows.
"""

__version__ = "0.1.0"

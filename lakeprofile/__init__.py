"""Company-profile lakehouse operators for PySpark.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing here collects rows, reads the clock or calls ``rand()``.
"""

__version__ = "0.1.0"

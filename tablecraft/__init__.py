"""tablecraft: wide-table analytics for loan and shop data, written as plain PySpark.

Layout
------
``sources``    files in and out, the shared working folder, and the stand-in views
``functions``  column expressions (labels, ordinal maps, days, masks)
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole studies composed from the operators
"""

__all__ = ["constants", "functions", "operators", "plans", "sources"]

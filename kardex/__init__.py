"""kardex: catalog reconciliation and data-quality operators on Spark.

Every public function takes and returns DataFrames or Columns; nothing is
collected to the driver except the small gate decisions documented where they
occur (schema checks, file-name gates, one ``isEmpty``).
"""

__version__ = "0.1.0"

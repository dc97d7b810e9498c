"""tessera: feature and profile jobs for ads, events and text on PySpark.

Subpackages:
    functions  - column expressions (scalar text, date, array helpers)
    operators  - DataFrame -> DataFrame jobs (groups, history, text, ...)
    sources    - readers and writers
    plans      - fixture views and the registry of named queries
"""

__version__ = "0.1.0"

"""martline: rental-listing files -> clean star schema, as Spark DataFrame operators.

Modules: ``sources`` (read, unite, land, write), ``streaming`` (incremental
ingestion), ``functions`` (column expressions), ``operators`` (DataFrame ->
DataFrame steps), ``plans`` (star build, ETL run, registered queries).
"""

__version__ = "0.1.0"

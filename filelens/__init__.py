"""filelens: file catalogues, JSON labels and label joins as Spark DataFrames.

Subpackages: ``functions`` (column expressions), ``sources`` (listings, labels,
tables, archives), ``operators`` (catalogue, stats, constraints, batches),
``sinks`` (Parquet, JSON, tables, JDBC), ``streaming`` (arriving files) and
``plans`` (the registered queries over the driver's tables).
"""

__version__ = "0.1.0"

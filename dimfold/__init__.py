"""dimfold: dimensional and fact data modelling on Apache Spark.

Operators (``dimfold.operators``) take and return DataFrames:
cumulative snapshots, SCD2 histories, de-duplication and contracts, wide
facts, property graphs, activity datelists and reduced monthly arrays.
"""

__version__ = "0.1.0"

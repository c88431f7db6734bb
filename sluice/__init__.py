"""sluice: landing, curation and analysis of slowly growing public datasets on Spark.

Every operator is a composition of DataFrame operations and built-in
functions, so Catalyst and adaptive query execution do the planning.
"""

__version__ = "0.1.0"

"""Statistical-area metrics on Spark.

A library of DataFrame and Structured Streaming operators that turn landed
census and survey releases into wide metric tables keyed by ``GEO_ID``,
boundary layers keyed by ``GEO_ID`` and five linked metadata tables.
"""

__version__ = "0.1.0"

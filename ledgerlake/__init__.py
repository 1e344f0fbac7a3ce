"""ledgerlake: account-statement ingestion, consolidation and reconciliation on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Catalyst
expressions; I/O lives in the job wrappers under ``plans/`` and ``streaming/``.
"""

__version__ = "0.1.0"

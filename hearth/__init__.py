"""hearth: Spark-native data work for listing-price valuation models.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, Spark windows/aggregates/joins and Spark ML stages.  Column names
are parameters whose defaults follow the listing schema in ``hearth.constants``.
"""

__version__ = "0.1.0"

"""edicta: a Spark-native engine for catalogs of public regulatory acts."""

__version__ = "0.1.0"

"""cartoria: a Spark-native engine for integrating, curating and auditing registries of places."""

__version__ = "0.1.0"

"""Spark-native corpus preparation and analytics.

``functions`` holds Column builders, ``operators`` DataFrame operators,
``sources`` scans and sinks, ``plans`` multi-step pipelines and the query
registry, ``streaming`` the Structured Streaming extension.
"""

__version__ = "0.1.0"

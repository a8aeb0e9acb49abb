"""tracelake: PySpark-native analytics for AI coding-agent traces."""

__version__ = "0.1.0"

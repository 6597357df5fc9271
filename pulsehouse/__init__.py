"""pulsehouse: a Spark-native warehouse for content-community behaviour
events - enrichment, activity / interaction / session / quality metrics,
cheat detection, new users, and key-value and lake outputs, for batch and
Structured Streaming."""

__version__ = "0.1.0"

"""cadenza: a Spark-native engine for speech datasets and transcript evaluation."""

__version__ = "0.1.0"

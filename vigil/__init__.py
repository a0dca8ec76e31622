"""vigil: a Spark-native curation, verification and training-set preparation library for
security-scan findings. Every operator is a DataFrame -> DataFrame function."""

__version__ = "0.1.0"

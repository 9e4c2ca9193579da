"""frameloom: a Spark-native engine that builds, packs, checks and scores multimodal supervision data."""

__version__ = "0.1.0"

"""quire - a Spark-native engine that turns manuscript libraries into token-budgeted training corpora."""

__version__ = "0.1.0"

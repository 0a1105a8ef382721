"""shardweave: a Spark-native engine for preparing multimodal training corpora.

Every operator is a DataFrame -> DataFrame function under one explicit ordering contract (see
:mod:`shardweave.operators.order`).  Nothing here runs at import time; pass your own SparkSession.
"""

__version__ = "0.1.0"

"""tamarack: a Spark-native engine for curating media and document corpora."""

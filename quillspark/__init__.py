"""quillspark: a Spark-native engine for document analytics, retrieval and usage reporting."""

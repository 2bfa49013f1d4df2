"""Spark-native evidence analytics: documents to addressable, classified, scored and verified evidence."""

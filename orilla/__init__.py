"""orilla: a Spark-native engine for large lots of image records and text corpora."""

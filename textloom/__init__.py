"""textloom: a PySpark-native engine for parallel, multilingual text corpora."""

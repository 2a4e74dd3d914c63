"""grafloom: a PySpark-native engine for building, repairing, querying and checking knowledge graphs."""

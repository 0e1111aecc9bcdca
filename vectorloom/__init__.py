"""vectorloom: PySpark-native analysis and search of vector configurations under angle constraints."""

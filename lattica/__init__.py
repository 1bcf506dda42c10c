"""lattica: a PySpark-native engine for sparse spatial tables and the catalogs around them."""

"""ledgerloom: a PySpark-native engine for messy ownership and dividend registers."""

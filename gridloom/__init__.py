"""gridloom: a PySpark-native analytics engine for session telemetry and text corpora."""

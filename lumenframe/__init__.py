"""lumenframe: text, table, statistics and graph operators as plain PySpark DataFrame functions."""

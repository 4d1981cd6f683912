"""A Spark-native engine for messy record feeds: scan, check, group, load, score and report."""

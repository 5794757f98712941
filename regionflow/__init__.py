"""regionflow: a PySpark-native engine for region-partitioned sequencing-read analysis."""

"""Spark-native analytics for transcript 3'-end (polyadenylation-site) data."""

"""Event-detection analytics on Spark: scans, linkage, features, joins and scores as DataFrame operators."""

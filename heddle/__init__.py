"""Heddle: catalog-quality analytics as composable DataFrame-to-DataFrame functions on Spark SQL."""

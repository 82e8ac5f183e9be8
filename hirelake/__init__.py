"""Spark-native warehouse for job adverts: landing, star schema, quality reports and analytics."""

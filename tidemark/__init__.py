"""Spark-native analytics for advertiser, contact, funnel and text data."""

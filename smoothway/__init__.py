"""Smoothway: a PySpark-native engine for road ride-quality data."""

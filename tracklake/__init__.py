"""Cleaning, checking, loading and querying animal-tracking data with Spark."""

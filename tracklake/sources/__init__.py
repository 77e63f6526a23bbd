"""Readers and writers: raw and clean CSV files, lookup files and tables."""

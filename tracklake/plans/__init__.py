"""Whole-dataset jobs: clean, load, delete, extract."""

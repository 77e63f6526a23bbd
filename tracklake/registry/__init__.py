"""The queries the driver runs on its own tables, each with SQL to check it."""

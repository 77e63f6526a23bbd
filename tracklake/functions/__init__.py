"""Column functions: missing values, text, numbers and times."""

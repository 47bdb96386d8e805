"""Column functions: cleaning, casting, periods, encoding."""

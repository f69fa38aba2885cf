"""Column functions: text, dates, money, hashes."""

"""Column helpers: parameters, dates, money and text."""

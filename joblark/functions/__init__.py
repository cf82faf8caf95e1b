"""Column functions: text, dates and HTML rules."""

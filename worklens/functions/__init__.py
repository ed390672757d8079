"""Column functions: text, time and business labels."""

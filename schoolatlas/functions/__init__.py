"""Column expressions: text, counts, place names, school names and labels."""

"""Reading and writing tables, models and reports."""

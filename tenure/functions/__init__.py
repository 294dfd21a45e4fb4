"""Column expressions: validity rules, country codes, time parsing."""

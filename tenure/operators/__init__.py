"""Reusable table operators: latest-wins dedup, SCD2, date spine, effective-dated join, checks."""

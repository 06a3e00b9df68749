"""Operators on tables: layout of written files, upsert by key, calendar, quality checks."""

"""The query catalogue: every query with the SQL that checks it."""

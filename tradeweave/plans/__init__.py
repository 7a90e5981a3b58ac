"""Whole runs, and the registered queries with the SQL they are held against."""

"""Readers and writers: raw CSV, star tables, contracts, tables and reports."""

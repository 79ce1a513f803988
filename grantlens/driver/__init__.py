"""Runs the plans on the test tables: input adapter, queries and their SQL."""

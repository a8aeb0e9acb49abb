"""Operators over the analysed tables: overview, parts, sessions, timeline, tools, files, counts."""

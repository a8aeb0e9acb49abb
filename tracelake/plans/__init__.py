"""Reusable plan shapes: distributed running totals, stored tables, the SQL surface."""

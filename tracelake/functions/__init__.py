"""Scalar column expressions and the log-line parser."""

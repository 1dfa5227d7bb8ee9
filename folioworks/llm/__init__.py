"""Operators for preparing training data.  Nothing outside this folder imports it but the entry module."""

"""Relational operators over option, stock, rate and membership tables."""

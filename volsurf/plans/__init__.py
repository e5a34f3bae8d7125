"""Composite dataflows: contracts, features, stocks, maintenance, quality."""

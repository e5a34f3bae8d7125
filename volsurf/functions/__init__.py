"""Scalar functions and pricing kernels."""

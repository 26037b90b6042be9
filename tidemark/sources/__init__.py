"""Contracts, file sources and layer tables."""

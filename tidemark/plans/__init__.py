"""Whole plans: silver and gold models, contract validation and its report."""

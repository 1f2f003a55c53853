"""Analytical jobs and data-quality jobs over the brokerage tables."""

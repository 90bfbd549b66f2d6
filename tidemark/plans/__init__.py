"""Composite jobs: cleaning, modelling, layer runs."""

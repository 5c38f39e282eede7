"""Composite plans: the models (D1-D10), mart building and the sync run."""

"""Composed plans: the registered queries, their SQL oracles, retrain flow."""

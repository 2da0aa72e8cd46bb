"""Distributed regressors and their cross-validated runs."""

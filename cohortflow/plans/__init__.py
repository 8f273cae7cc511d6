"""Composite plans (audit, feature stages, evaluation)."""

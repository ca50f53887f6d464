"""Operators for preparing language-model training data (kept apart: nothing else imports this subpackage)."""

"""Operators: pure DataFrame → DataFrame functions grouped by capability."""

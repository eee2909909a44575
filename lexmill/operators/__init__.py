"""Operators on tables of case rows."""

"""Payloads that were acquired before, as case rows."""

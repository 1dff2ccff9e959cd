"""Whole derivations composed from the operators."""

"""Whole inspections, composed from the operators."""

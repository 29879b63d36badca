"""Whole flows and parameterised reports built from the operators."""

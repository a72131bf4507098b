"""Domain calculations composed from the operators."""

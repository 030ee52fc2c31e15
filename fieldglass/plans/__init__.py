"""End-to-end entry points composed of the operators."""

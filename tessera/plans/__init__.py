"""Named analytics plans built from the operators."""

"""Part of the loomwright engine; see the package docstring."""

"""Part of tagwright."""

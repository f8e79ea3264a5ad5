"""Part of mnemoweave."""

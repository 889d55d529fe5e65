"""Part of rollweave; see README.md."""

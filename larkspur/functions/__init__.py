"""Part of larkspur; see README.md."""

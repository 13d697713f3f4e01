"""Incremental runs: raw CSV → bronze append, bronze → silver merge."""

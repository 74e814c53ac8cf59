"""The operators that need one row only, run on files as they come in."""

"""Table operators: profile, detect, validate, clean, mask."""

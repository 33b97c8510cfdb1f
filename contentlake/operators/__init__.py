"""DataFrame operators: validation, error manifest, watermarks, latest row, merge."""

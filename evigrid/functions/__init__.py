"""Column functions: text, URLs, keys, signals and cascades. All are built-in expressions."""

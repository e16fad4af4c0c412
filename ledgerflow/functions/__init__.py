"""Column expressions: entity specifications, parsing and version-aware merging."""

"""Column expressions: key parsing, labels, minted identifiers, path trimming."""

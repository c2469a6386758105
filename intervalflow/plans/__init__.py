"""Driver bindings: fixtures over the given tables, named queries and their SQL oracles."""

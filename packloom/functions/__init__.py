"""Column builders: identifiers, text rules and file signatures."""

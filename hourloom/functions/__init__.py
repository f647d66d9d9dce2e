"""Column expressions: no DataFrame goes in or out of this package."""

"""DataFrame operators, grouped by study."""

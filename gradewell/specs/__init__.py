"""Model constants, rule tables and column lists, kept as data."""

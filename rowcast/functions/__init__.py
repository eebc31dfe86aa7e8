"""Column helpers: exact money arithmetic, repeatable draws, log text."""

"""Tables and their roles."""

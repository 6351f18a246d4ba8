"""Composite queries (what the dashboard answers) and their driver bindings."""

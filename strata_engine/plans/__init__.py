"""Layer plans and the registered queries."""

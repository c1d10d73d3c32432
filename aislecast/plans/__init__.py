"""Jobs that put the operators together, and the registered queries."""

"""Star-schema views, the staged workflow and the registered queries."""

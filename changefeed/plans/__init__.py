"""User entry points (jobs) and the registered queries."""

"""Zone jobs, zone stand-ins built from the driver tables, and the query catalogue."""

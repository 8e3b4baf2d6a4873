"""Sources: driver tables, delimited/JSON files, and the retail/employee
views derived from the driver tables."""

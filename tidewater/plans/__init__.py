"""Jobs built from the operators, and the queries registered on the driver's tables."""

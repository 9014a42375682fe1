"""End-to-end compositions of the operators and the driver-table query registry."""

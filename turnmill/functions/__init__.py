"""Column-to-column building blocks; all native expressions."""

"""Column expressions; all native, no Python UDFs."""

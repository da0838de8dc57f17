"""DataFrame -> DataFrame operators; each takes column names, not a domain."""

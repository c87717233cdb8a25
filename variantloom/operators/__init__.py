"""DataFrame -> DataFrame operators; every one takes column names."""

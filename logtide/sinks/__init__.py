"""Writers: event logs, quarantined files, clustered tables, gated appends, JDBC."""

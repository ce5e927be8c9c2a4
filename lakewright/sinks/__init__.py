"""Writers: partitioned tables, catalog entries, materialisations and audit rows."""

"""Writers for report tables, ledger files and the catalog."""

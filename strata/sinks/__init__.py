"""Writers, catalog tables and exports."""

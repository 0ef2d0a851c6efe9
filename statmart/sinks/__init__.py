"""Writers: tables (once, replace, log) and CSV export."""

"""Writers: tables, upserts in place, exports and versioned bundles."""

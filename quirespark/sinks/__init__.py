"""Writers of records, bundles and releases."""

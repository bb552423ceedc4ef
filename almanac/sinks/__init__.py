"""Writers: CSV exports and the versioned history."""

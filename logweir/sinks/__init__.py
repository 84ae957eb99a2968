"""Writers: staging files and append-only target tables."""

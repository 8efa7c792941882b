"""Plan helpers: staging, size checks, ordered scans."""

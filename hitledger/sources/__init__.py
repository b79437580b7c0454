"""File listings, text scans, dimension tables and the parsed table."""

"""Writers: tables and search documents."""

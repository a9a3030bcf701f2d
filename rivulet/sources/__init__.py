"""Sources: tables and file trees, lines, random items, copies, running IDs and limits."""

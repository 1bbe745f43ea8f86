"""Reading landing folders, sidecars and ledgers; writing tables, files and reports."""

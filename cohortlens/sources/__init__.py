"""Reading and writing: CSV, catalog tables, the audit log, cohort tables from orders."""

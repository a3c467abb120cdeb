"""Before/after analytics for renewal-style tables, written as plain DataFrame jobs."""

"""End-to-end batch jobs, fixture views and their reference SQL."""

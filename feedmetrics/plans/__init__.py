"""Layer-to-layer plans, jobs and views."""

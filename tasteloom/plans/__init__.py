"""Session settings and the jobs that join the operators into products."""

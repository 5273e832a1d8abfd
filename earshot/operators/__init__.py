"""DataFrame operators shared by the jobs and the analyses."""

"""DataFrame operators for auditing property assessments at scale."""

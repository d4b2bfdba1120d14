"""From landing to curated datasets, reports on them, and checks of the zones."""

"""The film catalogue derived from the order tables, the registered queries on it and their SQL."""

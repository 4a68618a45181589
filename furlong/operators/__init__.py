"""DataFrame -> DataFrame operators (reports, lookups, pedigree)."""

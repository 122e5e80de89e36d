"""Models: staging (silver), star schema (core), marts (gold), data quality, checks, gates."""

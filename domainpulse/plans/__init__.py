"""Plans: bridge tables, the full chain, the query catalog and its oracle SQL."""

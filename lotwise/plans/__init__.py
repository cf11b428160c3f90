"""Plans: derived views, registered queries and their SQL oracle."""

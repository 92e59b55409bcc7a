"""Plans: the experiment as a whole."""

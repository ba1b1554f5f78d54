"""Plans: operators composed into whole relations."""

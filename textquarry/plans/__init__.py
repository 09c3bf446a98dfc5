"""Plans: adapters, dispositions and the passes built from operators."""

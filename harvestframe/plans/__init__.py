"""Layer builds and downstream plans: silver, gold, model data, scoring, lineage, pipeline."""

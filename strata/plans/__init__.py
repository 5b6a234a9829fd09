"""End-to-end plans: cleaning pipeline, mart batch, modelling run."""

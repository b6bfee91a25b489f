"""The steps of an experiment, and the whole run."""

"""Query plans: registered queries and the batch pipeline."""

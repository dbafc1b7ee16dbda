"""Query plans: the registered queries and the batch job."""

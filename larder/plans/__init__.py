"""Complete batch jobs chained from the operators."""

"""DataFrame operators: transactions and the versioned current state."""

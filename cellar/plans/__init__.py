"""Job plans built from the operators, the derived inputs, and the registered queries."""

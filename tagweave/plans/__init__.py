"""Job plans: the four batch jobs as compositions of operators."""

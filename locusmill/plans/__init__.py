"""End-to-end data products, composed from the operators."""

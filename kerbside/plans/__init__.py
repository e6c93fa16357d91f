"""Models, reports and questions composed from the operators."""

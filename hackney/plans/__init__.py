"""The monthly jobs and the reports, composed of the operators."""

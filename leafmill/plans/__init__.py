"""Reports over the flyer and offer tables, and the operators applied to the test tables."""

"""Named queries: the catalogue, and every operator on the test tables with its SQL twin."""

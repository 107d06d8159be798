"""Every operator run on the shared test tables, with an equal SQL text where one exists."""

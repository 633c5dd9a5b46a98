"""Example queries of every operator on tables derived from the test data, with SQL oracles."""

"""Named query plans over the test tables and their SQL oracles."""

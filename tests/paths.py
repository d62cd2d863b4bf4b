"""Places of the given tables that tests read."""

SF_SMALL = "/root/testdata/sf0.001"

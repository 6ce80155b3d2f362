"""The given tables that the tests read."""

SF = "/root/testdata/sf0.001"

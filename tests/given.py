"""Where the given tables lie."""

DATA = "/root/testdata/sf0.001"

"""Where the small tables of the tests lie."""

DATA = "/root/testdata/sf0.001"

"""Where the supplied tables are."""

SF_DIR = "/root/testdata/sf0.01"

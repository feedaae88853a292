"""Where the given tables lie; a module of its own, because each folder has a conftest."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

"""Folders of the given tables that the tests of the training-data operators read."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

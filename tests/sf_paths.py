"""Folders of the given tables. A module of its own: tests never import a ``conftest``, whose name
every test folder shares."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

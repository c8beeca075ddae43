"""The operators applied to the test tables, with SQL that must agree."""

"""The named analyses, their mapping to the test tables and the SQL they are checked with."""

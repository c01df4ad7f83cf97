"""The library's operators run on the test tables, with the SQL that checks each of them."""

"""Every operator put to work on the test tables, with the SQL that checks it."""

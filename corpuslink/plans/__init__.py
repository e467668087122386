"""Registered queries over the sample tables, with the SQL that checks them."""

"""The registered queries and the SQL statements that check them."""

"""The registered queries and, for each, the SQL it is compared with."""

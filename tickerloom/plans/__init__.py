"""The query catalogue: one named query per operator, with its check SQL where one exists."""

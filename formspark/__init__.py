"""formspark: Spark jobs for the table side of document intake and review."""

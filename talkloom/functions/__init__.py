"""Column functions: text, chat requests, verdicts and scores."""

"""Order-aware relational operators shared by the sheet plans."""

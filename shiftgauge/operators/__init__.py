"""Row-set operators shared by the plans."""

"""What several test files share."""


def rows(df):
    """All rows as tuples, sorted with NULL first."""
    return sorted(map(tuple, df.collect()), key=repr)

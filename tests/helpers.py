"""What several test modules share."""

SF_DIR = "/root/testdata/sf0.001"


def column(df, key, value):
    """One column of a small result as a dict."""
    return {row[key]: row[value] for row in df.collect()}

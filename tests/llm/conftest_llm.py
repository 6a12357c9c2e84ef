"""Helpers of the tests in this folder."""


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of(df):
    return df.collect()

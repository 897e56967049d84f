"""Which rows are the same video, and how a video is printed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vidtrend.schema import MISSING_ID, PLACEHOLDER_IDS


def is_placeholder(c: str | Column = "video_id") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isin(*PLACEHOLDER_IDS)


def identity(video_id: str = "video_id", title: str = "title") -> Column:
    """The grouping key of a video: its id, or its title when the id is a
    spreadsheet error code.  Rows of both error codes with one title, and a
    row whose title equals another row's id, fall in one group."""
    return F.when(is_placeholder(video_id), F.col(title)).otherwise(F.col(video_id))


def payload_token(video_id: str = "video_id", title: str = "title") -> Column:
    """The text carried next to the identity: the error code for a row keyed
    by title, the title otherwise."""
    return F.when(is_placeholder(video_id), F.col(video_id)).otherwise(F.col(title))


def report_id(identity_col: str = "identity", token_col: str = "token") -> Column:
    """Printed id of a video: ``N/A`` when the winning token is an error code.
    A normal video whose title happens to be an error code also prints ``N/A``
    (kept on purpose: same output as the original)."""
    return F.when(is_placeholder(token_col), F.lit(MISSING_ID)).otherwise(F.col(identity_col))


def report_title(identity_col: str = "identity", token_col: str = "token") -> Column:
    """Printed title: the identity (which is the title) for a title-keyed video."""
    return F.when(is_placeholder(token_col), F.col(identity_col)).otherwise(F.col(token_col))

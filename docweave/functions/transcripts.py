"""Video transcript column functions (operators T1-T3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.constants import (
    TRANSCRIPT_SPEAKER_PATTERN,
    TRANSCRIPT_TIMECODE_PATTERN,
    VIDEO_ID_PATTERN,
)
from docweave.functions.urls import _col

# Java reads \s, \S, \d and \w as ASCII unless (?U) is given; the patterns are
# defined with Unicode classes, so every use below carries (?U).


def video_id(url) -> Column:
    """Operator T1: first 11 id characters after a recognised video-URL prefix
    (search anywhere in the string); null when there is none."""
    return F.nullif(F.regexp_extract(_col(url), "(?U)" + VIDEO_ID_PATTERN, 1), F.lit(""))


def clean_transcript(text) -> Column:
    """Operator T2: delete ``[h:mm:ss]`` time codes and ``<tag>`` speaker tags
    (closing tags stay)."""
    t = F.regexp_replace(_col(text), "(?U)" + TRANSCRIPT_TIMECODE_PATTERN, "")
    return F.regexp_replace(t, "(?U)" + TRANSCRIPT_SPEAKER_PATTERN, "")


def canonical_video_url(vid) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), _col(vid))


def transcript_markdown(vid, url, text) -> Column:
    """Operator T3 body: header, source URL, cleaned text."""
    return F.concat(
        F.lit("# YouTube Transcript: "), _col(vid),
        F.lit("\n\n**URL:** "), _col(url),
        F.lit("\n\n"), _col(text),
    )

"""Text expressions: blanks, whitespace, mentions and links, chunks, previews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip sees it.
_SPACES = r"\s\p{Z}\x0b\x1c-\x1f\x85"

# Fixed values of the scoring contract.
CHUNK_SIZE = 512
SHORT_TEXT = 3
TRUNCATED = "... [truncated]"


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def combine_text(title: Column, text: Column) -> Column:
    """Title and body with one space between; two blanks give ``" "``."""
    return F.concat_ws(" ", blank_if_null(title), blank_if_null(text))


def strip_ws(col: Column) -> Column:
    """Unicode-aware strip; ``F.trim`` would take spaces only.

    Takes the text from its first to its last visible character: the middle is
    passed over in one greedy step, which costs no more than its length.
    """
    visible = f"[^{_SPACES}]"
    return F.regexp_extract(col, f"(?s){visible}(?:.*{visible})?", 0)


def has_text(col: Column) -> Column:
    """Whether anything but whitespace is there; stops at the first such character."""
    return F.coalesce(F.rlike(col, F.lit(f"[^{_SPACES}]")), F.lit(False))


def normalize_mentions_links(col: Column) -> Column:
    """Whole tokens ``@name`` become ``@user`` and ``http...`` become ``http``.

    Tokens are what single spaces separate, so a token may hold a newline. A
    lone ``@`` stays. Most posts hold neither, so the regular expressions run
    only where a byte search finds a candidate.
    """
    text = blank_if_null(col)
    mentions = F.when(
        F.contains(text, F.lit("@")), F.regexp_replace(text, "(^| )@[^ ]+", "$1@user")
    ).otherwise(text)
    return F.when(
        F.contains(text, F.lit("http")), F.regexp_replace(mentions, "(^| )http[^ ]*", "$1http")
    ).otherwise(mentions)


def is_too_short(col: Column, n: int = SHORT_TEXT) -> Column:
    """Null, or fewer than ``n`` characters once stripped.

    Looks for two visible characters at least ``n - 2`` apart and stops at the
    first such pair, which spares the copy that stripping a long text makes.
    """
    if n < 2:
        return ~has_text(col) if n == 1 else col.isNull()
    long_enough = f"[^{_SPACES}](?s:.){{{n - 2},}}?[^{_SPACES}]"
    return ~F.coalesce(F.rlike(col, F.lit(long_enough)), F.lit(False))


def chunk_text(
    col: Column, size: int = CHUNK_SIZE, max_chunks: int | None = None
) -> Column:
    """Array of ``size``-character pieces of the whole text, or of its first ``max_chunks``."""
    if max_chunks is not None:
        col = F.substring(col, 1, size * max_chunks)
    return F.regexp_extract_all(col, F.lit(f"(?s).{{1,{size}}}"), 0)


def cut_text(col: Column, size: int = CHUNK_SIZE) -> Column:
    """For display: the text, or its first chunk and a marker where it was longer."""
    return F.when(
        F.length(col) > size, F.concat(F.substring(col, 1, size), F.lit(TRUNCATED))
    ).otherwise(col)


def preview(col: Column, n: int) -> Column:
    """First ``n`` characters and an ellipsis, the latter only where cut."""
    text = blank_if_null(col)
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(
        text
    )

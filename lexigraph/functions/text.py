"""String functions on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character up to U+0020: what the JVM's String.trim strips. Spark's own trim strips
# blanks only.
CONTROL_CHARS = "".join(map(chr, range(0x21)))

SUMMARY_SEPARATOR = ";"


def java_trim(s: Column) -> Column:
    return F.btrim(s, F.lit(CONTROL_CHARS))


def fields(s: Column) -> Column:
    """Whitespace-separated fields of a trimmed line; an empty line has one empty field."""
    return F.split(java_trim(s), r"\s+")


def tokens(s: Column) -> Column:
    """Non-empty tokens between blanks, tabs, line and form feeds."""
    return F.filter(F.split(s, r"[ \t\n\r\f]+"), lambda t: t != "")


def decade(year: Column) -> Column:
    """``1998`` -> ``199``."""
    return F.substring(year, 1, 3)


def decade_label(d: Column) -> Column:
    """``199`` -> ``1990``."""
    return F.concat(d, F.lit("0"))


def split_first(s: Column, sep: str = SUMMARY_SEPARATOR) -> tuple[Column, Column]:
    """Text before and after the first separator; the second is NULL without one."""
    at = F.locate(sep, s)
    return (
        F.when(at > 0, F.substring_index(s, sep, 1)),
        F.when(at > 0, F.substr(s, at + len(sep))),
    )


def base_name(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def extension(url: Column) -> Column:
    """Text after the last dot, the whole string if there is none."""
    return F.substring_index(url, ".", -1)


def image_format(url: Column) -> Column:
    """Output format named by the extension; ``jpe`` is written as ``jpg``."""
    ext = extension(url)
    return F.when(F.lower(ext) == "jpe", F.lit("jpg")).otherwise(ext)


def summary_line(item: Column, thumb: Column) -> Column:
    return F.concat_ws(SUMMARY_SEPARATOR, item, thumb)


def gallery_line(item: Column, thumb_url: Column) -> Column:
    return F.format_string(
        '<a href="%s"><img src="%s" width="50" height="50"></a>', item, thumb_url
    )


def pair_literal(p1: Column, p2: Column) -> Column:
    return F.format_string('"%s" + Constants.S + "%s",', p1, p2)


def numbered_thumb(worker: Column, number: Column) -> Column:
    """``worker_3``: the name a worker gives its fourth thumbnail."""
    return F.concat_ws("_", worker, number.cast("string"))


def elapsed_ms(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


def whole_number(s: Column) -> Column:
    """BIGINT with an optional sign, NULL for anything else."""
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("bigint"))
